"""Input folder: listing, header recognition, file issues and the manifest of handled files.

Tasks read the first records of each CSV file; one scan of the lines tells what needs the whole file.
"""

import csv
import io
import re
import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import constants as const
from lakestrata.functions.text import decoded_path, extension_of, file_name_of
from lakestrata.session import materialize
from lakestrata.sources.storage import FileInfo, file_info, file_infos, list_folder, open_input

NOT_UTF8 = "not all of the file is UTF-8"
HIDDEN_NAME = "a scan leaves out names that begin with an underscore"
#: Files that one task opens, where tasks open files themselves.
FILES_PER_TASK = 64
#: From so many files on they are scanned as ranges of names in their folder, if no more ranges than these are needed.
MANY_FILES, NAME_RANGES = 200, 16
_PLAIN = re.compile(r"[A-Za-z0-9-][A-Za-z0-9._-]*")  # names that Spark neither hides nor encodes
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
HEAD_SCHEMA = "path string, first_record array<string>, has_more boolean, problem string, problem_kind string"


def list_files(
    spark: SparkSession, folder: str, extensions: Sequence[str] = const.SUPPORTED_EXTENSIONS
) -> DataFrame:
    """Regular files directly below ``folder``, empty ones and names with ``_`` included.

    Only metadata is read. Names that begin with a dot and Spark's own success mark are not input. Sub-folders
    are left alone, so an archive folder inside the input folder is never touched.
    """
    return _listing(spark, [info for info in list_folder(spark, folder) if _is_input(info)], extensions)


def _is_input(info: FileInfo) -> bool:
    name = info.path.rsplit("/", 1)[-1]
    return info.is_file and not name.startswith(".") and name != "_SUCCESS"


def named_files(
    spark: SparkSession, names: Sequence[str], extensions: Sequence[str] = const.SUPPORTED_EXTENSIONS
) -> DataFrame:
    """The same listing for files known by name; a name given twice is one file, a lost one is none."""
    return _listing(spark, list(file_infos(spark, sorted(set(names)))), extensions)


def _listing(spark: SparkSession, infos: Sequence[FileInfo], extensions: Sequence[str]) -> DataFrame:
    """Path, size, time, name, extension and whether it is accepted, per file."""
    listing = spark.createDataFrame(pa.table({
        "path": pa.array([i.path for i in infos], pa.string()), "length": pa.array([i.length for i in infos], pa.int64()),
        "modified": pa.array([i.modified for i in infos], pa.int64())}))
    return listing.withColumns({
        "file_name": file_name_of("path"), "extension": extension_of("path"),
    }).withColumn("supported", F.col("extension").isin(*extensions))


def unsupported_files(files: DataFrame) -> DataFrame:
    return files.where(~F.col("supported"))


def _first_record(text: Iterator[str]) -> tuple[list[str] | None, bool]:
    """The first record that is not a blank line, and whether another one follows."""
    records = (record for record in csv.reader(text) if record)
    first = next(records, None)
    return first, next(records, None) is not None


def _read_head(path: str) -> tuple:
    csv.field_size_limit(sys.maxsize)  # a cell may be of any length
    try:
        with open_input(path) as stream:
            # whether the whole file decodes is not decided by its beginning
            text = io.TextIOWrapper(stream, encoding="utf-8-sig", errors="replace", newline="")
            first, more = _first_record(text)
            return first, more, None, None
    except csv.Error as error:
        return None, False, str(error), "content"
    except OSError as error:
        return None, False, str(error), "access"


def _read_heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        heads = pd.DataFrame(
            [_read_head(path) for path in batch["path"]],
            columns=["first_record", "has_more", "problem", "problem_kind"])
        heads.insert(0, "path", batch["path"].to_list())
        yield heads


def csv_heads(files: DataFrame) -> DataFrame:
    """First record of every CSV file. Tasks open each file and stop after its second record."""
    paths = files.where(F.col("extension") == ".csv").select("path")
    return spread(paths, paths.count()).mapInPandas(_read_heads, HEAD_SCHEMA)


def spread(paths: DataFrame, number: int) -> DataFrame:
    """Names of so many files dealt to tasks, to open a few each; adaptive execution would leave them all to one."""
    return paths.repartition(max(1, -(-number // FILES_PER_TASK)))


def csv_text_facts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Per CSV file with content: whether all of it is UTF-8, and whether a quoted cell has a line break.

    One scan of the lines. A line with an odd number of quotes begins or ends a cell that goes over lines.
    """
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return scan_files(spark, paths, spark.read.text).groupBy(decoded_path("_metadata.file_path").alias("path")).agg(
        F.bool_and(F.is_valid_utf8("value")).alias("decodes"), F.bool_or(quotes % 2 == 1).alias("multi_line"))


def scan_names(files: DataFrame) -> list[str]:
    """The names of the listed files for a scan, which needs them on the driver in any case; escaped, in order.

    They are sorted there, as Spark would work out the files twice to sort their names.
    """
    names = files.select(F.regexp_replace("path", r"([\[\]{}*?\\])", r"\\$1").alias("name"))
    return sorted(names.toArrow().column("name").to_pylist())


def scan_files(spark: SparkSession, names: Sequence[str], read: Callable[[list[str]], DataFrame]) -> DataFrame:
    """A scan of the files of these (escaped) names; ``read`` makes one of a list of paths.

    Spark looks up each path of a scan on its own. So many files are scanned by their folder, of which ranges of names
    leave just the given ones; Spark drops other files by that filter before it opens any. If a file comes or goes while
    the scan is made, or the names of other files lie between the given ones too often, they are looked up by name, a few
    tasks a core.
    """
    rows = _scan_ranges(spark, names, read) if len(names) >= MANY_FILES else None
    if rows is not None:
        return rows
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        return read(list(names))
    finally:
        spark.conf.set(_LISTING, before)


def _visible_names(spark: SparkSession, folder: str) -> list[str] | None:
    """The names in an (escaped) folder that Spark does not hide, in order; None if it holds folders or names to encode."""
    infos = list(list_folder(spark, re.sub(r"\\(.)", r"\1", folder)))
    names = sorted(info.path.rsplit("/", 1)[1] for info in infos)
    shown = [name for name in names if not name.startswith((".", "_"))]
    plain = all(_PLAIN.fullmatch(name) for name in shown) and not any(
        "=" in name for name in names if name.startswith("_"))
    return shown if plain and all(info.is_file for info in infos) else None


def _scan_ranges(spark: SparkSession, names: Sequence[str], read: Callable[[list[str]], DataFrame]) -> DataFrame | None:
    """The scan by ranges of names, None if the files cannot be told so."""
    folders = {name.rsplit("/", 1)[0] for name in names}
    wanted = {name.rsplit("/", 1)[1] for name in names}
    if len(folders) > 1 or not all(_PLAIN.fullmatch(name) for name in wanted):
        return None
    folder = folders.pop()
    held = _visible_names(spark, folder)
    rows = None if held is None or not wanted.issubset(held) else read([folder])
    # the listing that the scan holds is this one if nothing came or went meanwhile
    if rows is None or len(rows._jdf.inputFiles()) != len(held) or _visible_names(spark, folder) != held:
        return None
    ranges: list[list[str]] = []
    last = False
    for name in held:
        if name in wanted:
            if last:
                ranges[-1][1] = name
            else:
                ranges.append([name, name])
        last = name in wanted
    if len(ranges) > NAME_RANGES:
        return None
    if len(wanted) == len(held):
        return rows
    inside = F.lit(False)
    for low, high in ranges:
        inside = inside | F.col("_metadata.file_name").between(low, high)
    return rows.where(inside)


def looks_like_header(record: Column | str) -> Column:
    """Any cell contains one of the header words, ignoring case (substring test)."""
    cells = F.col(record) if isinstance(record, str) else record
    return F.exists(cells, lambda cell: F.lower(cell).rlike("|".join(const.HEADER_KEYWORDS)))


def sniff_layout(
    heads: DataFrame, canonical: Sequence[str] = const.HEADERLESS_NARROW, name_extra: bool = False
) -> DataFrame:
    """Adds ``has_header`` and ``columns``.

    A file without a header gets the canonical names, cut to their number; with ``name_extra`` it gets
    as many as its first record has, wider records being numbered ``extra_col_1`` and on.
    """
    width = F.size("first_record")
    names = F.array(*[F.lit(name) for name in canonical])
    if name_extra:
        beyond = F.transform(
            F.sequence(F.lit(1), F.greatest(width - len(canonical), F.lit(1))),
            lambda i: F.concat(F.lit(const.EXTRA_COLUMN_PREFIX), i.cast("string")))
        names = F.when(width > len(canonical), F.concat(names, beyond)).otherwise(
            F.slice(names, F.lit(1), F.greatest(width, F.lit(1))))
    header = F.coalesce(looks_like_header("first_record"), F.lit(False))
    return heads.withColumn("has_header", header).withColumn(
        "columns", F.when(header, F.col("first_record")).when(
            F.col("first_record").isNotNull(), names))


def final_names(columns: Column) -> Column:
    """Tidied and aliased names of a layout, as an array."""
    tidy = F.transform(columns, lambda c: F.lower(F.trim(c)))
    aliases = F.create_map(*[F.lit(x) for pair in const.ALIASES.items() for x in pair])
    return F.transform(tidy, lambda c: F.coalesce(aliases[c], c))


def missing_required(columns: Column, required: Sequence[str] = const.REQUIRED_COLUMNS) -> Column:
    """Required names a layout does not provide, as an array."""
    wanted = F.array(*[F.lit(name) for name in required])
    return F.array_except(wanted, final_names(columns))


def _issue(marker_reason: tuple[str, str], *values: Column) -> Column:
    marker, reason = marker_reason
    text = F.format_string(reason, *values) if values else F.lit(reason)
    return F.struct(F.lit(marker).alias("order_id"), text.alias("Reason"))


def _as_issue_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("issue").isNotNull()).select(
        "issue.order_id", F.col("file_name").alias("source_file"), "issue.Reason",
        F.lit(const.ISSUE_FILLER).alias("order_date"), F.lit(const.ISSUE_FILLER).alias("product"))


def csv_issue(layout: DataFrame) -> Column:
    """The first thing wrong with a CSV file, null if it can be read."""
    problem, width = F.col("problem"), F.size("first_record")
    # A file that holds nothing but its header has no rows to judge.
    has_rows = F.col("has_more") | ~F.col("has_header")
    return (
        F.when(F.col("problem_kind") == "access", _issue(const.ISSUE_UNREADABLE, problem))
        .when(F.col("problem_kind") == "content", _issue(const.ISSUE_BAD_CSV, problem))
        .when(~F.coalesce("decodes", F.lit(True)), _issue(const.ISSUE_BAD_CSV, F.lit(NOT_UTF8)))
        .when(F.col("first_record").isNull(), _issue(const.ISSUE_EMPTY))
        .when(~F.col("has_header") & (width < 2), _issue(
            const.ISSUE_BAD_CSV, F.format_string(const.ISSUE_TOO_NARROW, width)))
        .when(has_rows & (F.size(missing_required(F.col("columns"))) > 0),
              _issue(const.ISSUE_SCHEMA)))


def json_issue() -> Column:
    """The first thing wrong with a JSON file; one that holds no record at all has nothing to judge."""
    return (
        F.when(F.col("problem").isNotNull(), _issue(const.ISSUE_BAD_JSON, F.col("problem")))
        .when((F.col("records") > 0) & ~F.col("has_required"), _issue(const.ISSUE_SCHEMA)))


def json_file_facts(records: DataFrame) -> DataFrame:
    """Per JSON file of staged records: what keeps it from parsing, records, and whether it has the required columns.

    A file provides a column if a record of it has the key, whatever its value.
    """
    def has(name: str) -> Column:
        sources = [name] + [old for old, new in const.ALIASES.items() if new == name]
        return F.exists(F.map_keys("fields"), lambda k: F.lower(F.trim(k)).isin(*sources))

    required = F.lit(True)
    for name in const.REQUIRED_COLUMNS:
        required = required & F.coalesce(F.bool_or(has(name)), F.lit(False))
    return records.groupBy("path").agg(
        F.max("problem").alias("problem"), F.count("fields").alias("records"), required.alias("has_required"))


def examine_files(
    files: DataFrame, canonical: Sequence[str] = const.HEADERLESS_NARROW,
    json_rows: DataFrame | None = None, keep: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """Every listed file with its layout and its issue (null if it is fit to read): one row per file.

    ``json_rows`` are the staged records of the listed JSON files, if there are any. ``keep`` writes a work table, so
    that each CSV file is opened once for its head.
    """
    spark = files.sparkSession
    hidden = F.col("file_name").startswith("_")
    known = files.where(F.col("supported") & ~hidden)
    # Joins run on one row per file.
    layout = sniff_layout(keep(csv_heads(known), "heads"), canonical)
    names = scan_names(layout.where(F.col("problem_kind").isNull()))
    if names:
        layout = layout.join(csv_text_facts(spark, names), "path", "left")
    else:
        layout = layout.withColumns({"decodes": F.lit(True), "multi_line": F.lit(False)})
    judged = layout.withColumn("issue", csv_issue(layout)).select(
        "path", "has_header", "columns", "has_more", F.coalesce("multi_line", F.lit(False)).alias("multi_line"), "issue")
    nothing = {
        "has_header": F.lit(None).cast("boolean"), "columns": F.lit(None).cast("array<string>"),
        "has_more": F.lit(None).cast("boolean"), "multi_line": F.lit(None).cast("boolean")}
    result = known.where(F.col("extension") == ".csv").join(judged, "path")
    result = result.unionByName(unsupported_files(files).withColumns(nothing).withColumn(
        "issue", _issue(const.ISSUE_UNSUPPORTED, F.col("extension"))))
    result = result.unionByName(files.where(F.col("supported") & hidden).withColumns(nothing).withColumn(
        "issue", _issue(const.ISSUE_UNREADABLE, F.lit(HIDDEN_NAME))))
    if json_rows is not None:
        judged_json = known.where(F.col("extension") == ".json").join(
            json_file_facts(json_rows), "path", "left").withColumns(nothing)
        result = result.unionByName(
            judged_json.withColumn("issue", json_issue()).drop("problem", "records", "has_required"))
    return result


def file_issues(examined: DataFrame) -> DataFrame:
    """Issue rows ``order_id`` (marker), ``source_file``, ``Reason``, ``order_date``, ``product``."""
    return _as_issue_rows(examined)


# --- manifest ----------------------------------------------------------------------------------

#: A file is known by path, size and time, so a new delivery under an old name is a new file.
FILE_KEY = ["path", "length", "modified"]
MANIFEST_SCHEMA = (
    "path string, length bigint, modified bigint, disposition string, reason string, run string, handled_at timestamp")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All dispositions recorded so far; empty before the first run."""
    if file_info(spark, path) is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def record_dispositions(dispositions: DataFrame, path: str, run: str) -> None:
    """Append the dispositions of a run as one file, so that they appear together; files themselves are never moved."""
    dispositions.select(
        *FILE_KEY, "disposition", F.col("reason").cast("string").alias("reason"), F.lit(run).alias("run"),
        F.current_timestamp().alias("handled_at")).coalesce(1).write.mode("append").parquet(path)


def pending_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that have no disposition yet."""
    return files.join(manifest.select(*FILE_KEY).distinct(), FILE_KEY, "left_anti").select(*files.columns)
