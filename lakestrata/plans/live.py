"""Live view: raw files to bronze, silver and file issues in one read, nothing written."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import constants as const
from lakestrata.operators.columns import (
    add_processing_time, cast_known, pick_aliases, project_existing)
from lakestrata.operators.dedup import dedup_composite
from lakestrata.operators.gold import gold_daily_latest
from lakestrata.session import materialize
from lakestrata.sources import files as files_
from lakestrata.sources import tabular


@dataclass
class LiveView:
    """``files`` is the examined listing; ``bronze`` and ``silver`` are None if no file is readable."""

    files: DataFrame
    issues: DataFrame
    bronze: DataFrame | None
    silver: DataFrame | None


def examine(
    files: DataFrame, canonical: Sequence[str] = const.HEADERLESS_NARROW, keep=materialize,
) -> tuple[DataFrame, DataFrame | None]:
    """(listed files with layout and issue, staged JSON records or None), both written tables.

    ``keep`` writes a work table; JSON text is parsed once, into the staged records.
    """
    json_files = files.where((F.col("extension") == ".json") & ~F.col("file_name").startswith("_"))
    records = None if json_files.isEmpty() else keep(tabular.json_records(files.sparkSession, json_files), "json-records")
    return keep(files_.examine_files(files, canonical, records, keep), "examined"), records


def read_files(
    spark: SparkSession, readable: DataFrame, records: DataFrame | None, ragged: str = "pad",
    multi_line: bool = False,
) -> DataFrame | None:
    """All rows of the given examined files by column name, as text, with their position."""
    csv_files = readable.where(F.col("extension") == ".csv")
    rows = tabular.scan_csv_groups(spark, tabular.layout_groups(csv_files), ragged, True, multi_line)
    frames = [] if rows is None else [rows]
    json_files = readable.where(F.col("extension") == ".json").select("path")
    if records is not None:
        wanted = records.where(F.col("fields").isNotNull()).join(json_files, "path", "left_semi")
        if not wanted.isEmpty():
            frames.append(tabular.json_columns(wanted))
    return tabular.union_by_name(frames) if frames else None


def medallion_live(
    spark: SparkSession,
    path: str,
    canonical: Sequence[str] = const.HEADERLESS_NARROW,
    ragged: str = "pad",
    order_by: Sequence[str] | None = None,
    multi_line: bool = False,
) -> LiveView:
    """Bronze is every row of every acceptable file; silver keeps the first row per (id, date).

    "First" follows file name and place in the file, or ``order_by`` if given.
    """
    examined, records = examine(files_.list_files(spark, path), canonical)
    issues = files_.file_issues(examined)
    rows = read_files(spark, examined.where(F.col("issue").isNull()), records, ragged, multi_line)
    if rows is None:
        return LiveView(examined, issues, None, None)
    rows = rows.drop("source_path").withColumn("ingestion_timestamp", F.current_timestamp())
    silver = add_processing_time(dedup_composite(rows, order_by=order_by or tabular.POSITION))
    return LiveView(
        examined, issues, rows.drop(*tabular.POSITION), silver.drop(*tabular.POSITION))


def gold_live_rows(
    spark: SparkSession, path: str, ragged: str = "pad",
) -> DataFrame | None:
    """The rows of raw files under the names daily gold needs: aliases picked per layout."""
    files = files_.list_files(spark, path).where(~F.col("file_name").startswith("_"))
    examined, records = examine(files, const.HEADERLESS_WIDE)
    frames = []
    # files that lack a required column can still have a date
    layouts = examined.where(F.col("columns").isNotNull())
    for group in tabular.layout_groups(layouts):
        rows = tabular.scan_csv_layout(
            spark, group["paths"], group["columns"], group["has_header"], ragged,
            apply_aliases=False, with_position=True, multi_line=group["multi_line"])
        frames.append(_gold_input(rows))
    if records is not None and not records.where(F.col("fields").isNotNull()).isEmpty():
        frames.append(_gold_input(tabular.json_columns(records, apply_aliases=False)))
    if not frames:
        return None
    union = cast_known(tabular.union_by_name(frames))
    if "order_date" not in union.columns:
        union = union.withColumn("order_date", F.current_timestamp())
    return union


def gold_live(
    spark: SparkSession, path: str, ragged: str = "pad",
    tiebreak: Sequence[str] | None = None,
) -> DataFrame | None:
    """Daily gold straight from the raw files, the newest row per id: one row per day."""
    rows = gold_live_rows(spark, path, ragged)
    return None if rows is None else gold_daily_latest(rows, tiebreak=tiebreak or tabular.POSITION)


def _gold_input(rows: DataFrame) -> DataFrame:
    place = rows.columns[-len(tabular.POSITION):]
    data = [c for c in rows.columns if c not in (*place, "source_file", "source_path")]
    picked = pick_aliases(rows.select(*[F.col(f"`{c}`") for c in data], *place))
    return project_existing(picked, [*const.GOLD_INPUT_COLUMNS, *place])
