"""CSV, JSON and Parquet scans. Values are bound by column name, never by position in a schema."""

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata import constants as const
from lakestrata.functions.text import decoded_path, file_name_of, ratio_pct, tidy_name
from lakestrata.operators.columns import alias_names, conform, tidy_layout
from lakestrata.session import materialize
from lakestrata.sources import csvparts, jsonparts
from lakestrata.sources.files import list_files, named_files, scan_files, scan_names, spread
from lakestrata.sources.storage import list_folder, open_input

POSITION = ["_file", "_block", "_seq"]
_OVERFLOW = "_beyond_header"


def scan_csv_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header and types inferred from all rows (this reads the input twice)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def scan_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(path)


def partition_scan(
    spark: SparkSession, folder: str, by: str, start: str, end: str, value: str
) -> DataFrame:
    """One row: partition folders there are, those a scan of a range opens, and the total it finds.

    The folders are those of a table written by ``write_partitioned``; those opened are the ones the scan's rows
    come from.
    """
    wanted = scan_parquet(spark, folder).where(F.col(by).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    held = [i for i in list_folder(spark, folder) if not i.is_file and f"/{by}=" in i.path]
    by_folder = wanted.groupBy(F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1)).agg(F.sum(value).alias("n"))
    return by_folder.agg(
        F.lit(len(held)).cast("bigint").alias("total_partitions"), F.count(F.lit(1)).alias("partitions_scanned"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("filtered_total"),
    ).withColumn("scan_pct", ratio_pct(F.col("partitions_scanned"), F.col("total_partitions"))).withColumn(
        "pruning", F.when(F.col("partitions_scanned") < F.col("total_partitions"), "PASS").otherwise("ACTIVE"))


def _with_position(df: DataFrame, keep: bool) -> DataFrame:
    """Adds where a row stands in its file; the order of rows in a block follows the scan."""
    if not keep:
        return df
    return df.withColumns({
        "_file": decoded_path("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"),
        "_seq": F.monotonically_increasing_id()})


def scan_csv_layout(
    spark: SparkSession,
    paths: str | list[str],
    columns: Sequence[str],
    has_header: bool,
    ragged: str = "pad",
    apply_aliases: bool = True,
    with_position: bool = False,
    multi_line: bool = False,
    stretch: int = csvparts.STRETCH,
) -> DataFrame:
    """CSV files that share one layout, all values as text.

    Names are tidied, the first of each repeated name is kept, and aliases are applied. Short rows are
    padded with nulls. Over-long rows are cut (``ragged="pad"``) or left out (``ragged="skip"``). Blank
    lines are not rows, and a byte order mark is not part of the first name. ``multi_line`` allows line
    breaks inside quoted cells; a file larger than a ``stretch`` is then read by many tasks (one, if its lines end with
    carriage returns alone), others by one each, so it is off unless asked for.
    """
    slots = [f"_c{i}" for i in range(len(columns))]
    names = slots + ([_OVERFLOW] if ragged == "skip" else [])
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    reader = spark.read.schema(schema).option("header", has_header).option("escape", '"').option("multiLine", multi_line)
    rows = reader.csv(paths) if isinstance(paths, str) else scan_files(spark, paths, reader.csv)
    large = csvparts.large_files(spark, paths, stretch) if multi_line else []
    parts = [file for file in large if file["line_end"] != "\r"]
    if parts:
        unsplit = [file["path"] for file in large if file["line_end"] == "\r"]
        rows = rows.where((F.col("_metadata.file_size") <= stretch) | decoded_path("_metadata.file_path").isin(unsplit))
    rows = _with_position(rows.withColumn("source_file", decoded_path("_metadata.file_name")).withColumn(
        "source_path", decoded_path("_metadata.file_path")), with_position)
    if parts:
        rows = rows.unionByName(_csv_parts(spark, parts, schema, has_header, with_position, stretch))
    if ragged == "skip":
        rows = rows.where(F.col(_OVERFLOW).isNull())
    layout = tidy_layout(columns)
    targets = alias_names([n for _, n in layout]) if apply_aliases else [n for _, n in layout]
    return rows.select(
        *[F.col(slots[position]).alias(target)
          for (position, _), target in zip(layout, targets) if target is not None],
        "source_file", "source_path", *(POSITION if with_position else []))


def _csv_parts(
    spark: SparkSession, files: Sequence, schema: T.StructType, has_header: bool, with_position: bool, stretch: int
) -> DataFrame:
    """The rows of large files with line breaks in cells, as the reader gives those of small ones."""
    records = csvparts.csv_records(spark, files, stretch, has_header)
    cells = F.from_csv("record", schema.simpleString()[len("struct<"):-1].replace(":", " "), {"escape": '"'})
    rows = records.withColumn("cells", cells).select(
        *[F.col("cells")[name].alias(name) for name in schema.names], file_name_of("path").alias("source_file"),
        F.col("path").alias("source_path"), F.col("path").alias("_file"), "_block", "_seq")
    return rows if with_position else rows.drop(*POSITION)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column that a frame lacks is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def layout_groups(layouts: DataFrame) -> list[dict]:
    """Distinct layouts with the paths of their files; JSON files, if listed, form a group without one.

    There are as many layouts as different headers. The names of a layout's files come one by one, as a scan
    needs them on the driver.
    """
    if "multi_line" not in layouts.columns:
        layouts = layouts.withColumn("multi_line", F.lit(False))
    kinds = layouts.select("has_header", "columns", "multi_line").distinct().orderBy(
        F.desc("has_header"), F.col("columns").cast("string"), "multi_line").collect()
    groups = []
    for kind in kinds:
        same = F.lit(True)
        for name in ("has_header", "multi_line"):
            same = same & F.col(name).eqNullSafe(F.lit(kind[name]).cast("boolean"))
        wanted = F.lit(None) if kind["columns"] is None else F.array(*[F.lit(c) for c in kind["columns"]])
        same = same & F.col("columns").eqNullSafe(wanted.cast("array<string>"))
        groups.append({**kind.asDict(), "paths": scan_names(layouts.where(same))})
    return groups


def scan_csv_files(
    spark: SparkSession, layouts: DataFrame, ragged: str = "pad", with_position: bool = False,
    multi_line: bool = False,
) -> DataFrame | None:
    """All CSV files of ``layouts`` (path, has_header, columns): one scan per distinct layout, by name.

    Files of the same layout are read together, so the plan has as many branches as there are
    different headers and no join is needed to bind names to rows.
    """
    return scan_csv_groups(spark, layout_groups(layouts), ragged, with_position, multi_line)


def scan_csv_groups(
    spark: SparkSession, groups: Sequence, ragged: str = "pad", with_position: bool = False,
    multi_line: bool = False,
) -> DataFrame | None:
    """The files of some layouts. Of those with line breaks in cells, small ones are read by a task each."""
    frames = [
        scan_csv_layout(spark, group["paths"], group["columns"], group["has_header"], ragged,
                        with_position=with_position, multi_line=multi_line or bool(group["multi_line"]))
        for group in groups]
    return union_by_name(frames) if frames else None


def scan_csv_declared(
    spark: SparkSession, layouts: DataFrame, types: dict[str, str] | None = None
) -> DataFrame:
    """The declared columns of CSV files, found by header name and cast leniently."""
    rows = scan_csv_files(spark, layouts)
    types = types or const.DECLARED_TYPES
    if rows is None:
        return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in types.items()))
    return conform(rows, types)


JSON_SCHEMA = "path string, _block bigint, _seq bigint, fields map<string,string>, problem string"
_BAD_JSON, _NO_JSON = "malformed record", "no record"


def _as_text(value) -> str | None:
    """A JSON value as text; numbers as they are written."""
    if value is None:
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return text.encode("utf-8", "replace").decode("utf-8")


def _read_document(path: str) -> tuple[list[dict] | None, str | None]:
    """(records, what is wrong) of a file that holds one object or an array of them."""
    with open_input(path) as stream:
        content = stream.read()
    try:
        text = bytes(content).decode("utf-8-sig")
        if not text.strip():
            return None, _NO_JSON
        found = jsonparts.parse_record(text)
    except (ValueError, RecursionError):
        return None, _BAD_JSON
    found = found if isinstance(found, list) else [found]
    if not all(isinstance(record, dict) for record in found):
        return None, _BAD_JSON
    return found, None


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths to staged records; a file without any is one row without fields."""
    kind = pa.map_(pa.string(), pa.string())
    for batch in batches:
        for path in batch.column(0).to_pylist():
            records, problem = _read_document(path)
            rows = [_pairs(r) for r in records or []] or [None]
            yield pa.RecordBatch.from_arrays([
                pa.array([path] * len(rows)), pa.array([0] * len(rows), pa.int64()), pa.array(range(len(rows)), pa.int64()),
                pa.array(rows, kind), pa.array([problem] * len(rows), pa.string())],
                ["path", "_block", "_seq", "fields", "problem"])


def _pairs(record: dict) -> list[tuple[str, str | None]]:
    return [(str(k).encode("utf-8", "replace").decode(), _as_text(v)) for k, v in record.items()]


def json_records(spark: SparkSession, files: DataFrame, stretch: int = jsonparts.STRETCH) -> DataFrame:
    """Records of the listed JSON files: ``path, _block, _seq, fields, problem``, values as text.

    A file in which every line that is not blank is an object holds records line by line, and is split like any
    text. Any other one is a document: an object, or an array of objects, and nothing behind it. A document larger
    than a ``stretch`` that begins with a bracket is read by many tasks, others by one each. A file without a record
    has a row without fields, whose ``problem`` tells what is wrong, if anything is; beside such a row a large array may
    have records that precede or follow the wrong place, so a file with a ``problem`` is left out as a whole.
    """
    names = scan_names(files)
    plain = F.regexp_replace("value", "^\ufeff", "")
    lines = scan_files(spark, names, spark.read.text).select(
        decoded_path("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"),
        plain.alias("value")).where(F.trim("value") != "")
    # a line of a document may be an object, but not all of them unless there is only this one
    kinds = lines.groupBy("path").agg(F.bool_and(F.json_object_keys("value").isNotNull()).alias("lines"))
    by_line = kinds.where("lines").select("path")
    listed = files.select("path", "length").join(by_line, "path", "left_anti")
    parsed = lines.join(by_line, "path", "left_semi").select(
        "path", "_block", F.monotonically_increasing_id().alias("_seq"),
        F.from_json("value", "map<string,string>").alias("fields"), F.lit(None).cast("string").alias("problem"))
    number = large_stretches(files, stretch)
    if not number:
        return spread(listed.select("path"), len(names)).mapInArrow(_read_documents, JSON_SCHEMA).unionByName(parsed)
    large = jsonparts.arrays(listed.where(F.col("length") > stretch))
    documents = spread(listed.select("path").join(large.select("path"), "path", "left_anti"), len(names)).mapInArrow(
        _read_documents, JSON_SCHEMA)
    arrays = jsonparts.array_records(large, JSON_SCHEMA, _pairs, jsonparts.parse_record, _BAD_JSON, stretch, number)
    return documents.unionByName(arrays).unionByName(parsed)


def large_stretches(files: DataFrame, stretch: int) -> int:
    """How many stretches the listed files have that are larger than one; a look at the listing."""
    return files.where(F.col("length") > stretch).agg(
        F.coalesce(F.sum(F.ceil(F.col("length") / F.lit(stretch))), F.lit(0))).first()[0]


def json_columns(records: DataFrame, apply_aliases: bool = True) -> DataFrame:
    """Staged records as columns: every key found, tidied and aliased, and ``source_file, source_path`` and position.

    Of keys that come to the same name the first value that is not null counts.
    """
    held = records.where(F.col("fields").isNotNull())
    keys = sorted(r[0] for r in held.select(F.explode(F.map_keys("fields"))).distinct().collect())
    by_target: dict[str, list] = {}
    for key in keys:
        name = tidy_name(key)
        target = const.ALIASES.get(name, name) if apply_aliases else name
        by_target.setdefault(target, []).append(F.element_at("fields", F.lit(key)))
    return held.select(
        *[F.coalesce(*sources).alias(target) for target, sources in by_target.items()],
        file_name_of("path").alias("source_file"), F.col("path").alias("source_path"),
        F.col("path").alias("_file"), "_block", "_seq")


def scan_json(
    spark: SparkSession, path: str | list[str], types: dict[str, str] | None = None, stretch: int = jsonparts.STRETCH,
) -> DataFrame:
    """The declared columns of all JSON records that parse, of a folder, a file or some files."""
    types = types or const.DECLARED_TYPES
    files = list_files(spark, path) if isinstance(path, str) else named_files(spark, path)
    files = files.where(F.col("extension") == ".json")
    records = json_records(spark, files, stretch)
    if large_stretches(files, stretch):  # what is wrong with a large array may be found behind some of its records
        records = materialize(records, "json-records")
        records = records.join(records.where(F.col("problem").isNotNull()).select("path").distinct(), "path", "left_anti")
    # Keys are bound as they are, without aliases.
    return records.where(F.col("fields").isNotNull()).select(*[
        F.element_at("fields", F.lit(name)).try_cast(kind).alias(name) for name, kind in types.items()])
