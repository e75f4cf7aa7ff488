"""Run log, task log and record inspection."""

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata import constants as const
from lakestrata.functions.text import decoded_path
from lakestrata.operators.dedup import first_per_key
from lakestrata.sources.storage import file_info

RUN_SCHEMA = "dag_id string, run_id string, task_id string, status string, message string, timestamp timestamp"


def scan_logs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text logs with the name of their file and their place in it (``block``, ``position``)."""
    return spark.read.text(path).select(
        decoded_path("_metadata.file_name").alias("source"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"), F.col("value").alias("line"))


class RunLog:
    """An append-only log of what jobs did; a folder of small JSON files, one per event."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, dag_id: str, run_id: str, task_id: str, status: str, message: str = "") -> None:
        event = self.spark.range(1).select(
            *[F.lit(v).alias(n) for n, v in (("dag_id", dag_id), ("run_id", run_id), ("task_id", task_id),
                                             ("status", status), ("message", message))],
            F.current_timestamp().alias("timestamp"))
        event.coalesce(1).write.mode("append").json(self.path)

    def events(self) -> DataFrame:
        if file_info(self.spark, self.path) is None:
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).json(self.path)

    @contextmanager
    def task(self, dag_id: str, task_id: str, run_id: str | None = None) -> Iterator[str]:
        """RUNNING when the block begins, SUCCESS or ERROR when it ends; gives the run's id."""
        run_id = run_id or uuid.uuid4().hex
        self.add(dag_id, run_id, task_id, "RUNNING")
        try:
            yield run_id
        except BaseException as error:
            self.add(dag_id, run_id, task_id, "ERROR", str(error)[:const.READ_ERROR_LENGTH])
            raise
        self.add(dag_id, run_id, task_id, "SUCCESS")


def _last_lines(
    lines: DataFrame, source: str, order_by: Sequence[str | Column], count: int
) -> DataFrame:
    """The last lines per source; the rank limit keeps at most ``count`` per source and map task."""
    backwards = Window.partitionBy(source).orderBy(
        *[(F.col(c) if isinstance(c, str) else c).desc() for c in order_by])
    return lines.withColumn("from_end", F.row_number().over(backwards)).where(
        F.col("from_end") <= count)


def log_highlights(
    lines: DataFrame, source: str = "source", line: str = "line",
    order_by: Sequence[str | Column] = ("position",),
) -> DataFrame:
    """Keyword lines among the last lines of each log (newest few), and the tail of each log.

    One row per (source, section, line); ``from_end`` counts lines from the end of the log.
    """
    recent = _last_lines(lines, source, order_by, const.LOG_SCAN_LINES).select(
        source, "from_end", F.col(line).alias("line"))
    is_hit = F.upper("line").rlike("|".join(const.LOG_KEYWORDS))
    hits_so_far = F.count_if(is_hit).over(Window.partitionBy(source).orderBy("from_end"))

    def entry(section: str, text: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), text.alias("line"))

    sections = F.array_compact(F.array(
        F.when(F.col("is_hit") & (F.col("hits") <= const.LOG_HIGHLIGHTS), entry("highlight", F.trim("line"))),
        F.when(F.col("from_end") <= const.LOG_TAIL_LINES, entry("tail", F.col("line")))))
    return recent.withColumns({"is_hit": is_hit, "hits": hits_so_far}).select(
        source, "from_end", F.inline(sections))


def run_status_latest(
    events: DataFrame, pipeline: str = "dag_id", order_by: Sequence[str] = ("timestamp",)
) -> DataFrame:
    """The newest event per pipeline."""
    return first_per_key(events, [pipeline], [F.col(c).desc() for c in order_by])


def run_durations(
    events: DataFrame, run: str = "run_id", task: str = "task_id", moment: str = "timestamp"
) -> DataFrame:
    """Seconds from first to last event and the number of tasks, per run."""
    def micros(c: Column) -> Column:
        return F.unix_micros(c.cast("timestamp"))

    span = micros(F.max(moment)) - micros(F.min(moment))
    return events.groupBy(run).agg(
        F.min(moment).alias("started"), F.max(moment).alias("finished"),
        (span / F.lit(1_000_000)).cast("double").alias("duration_seconds"),
        F.count_distinct(F.col(task)).alias("task_count"))


def record_inspection(
    valid: DataFrame, rejected: DataFrame, order_by: Sequence[str], rows: int = 50
) -> DataFrame:
    """The first valid and the first rejected records under one schema, labelled."""
    def top(df: DataFrame, label: str) -> DataFrame:
        return df.orderBy(*order_by).limit(rows).withColumn("record_state", F.lit(label))

    return top(valid, "valid").unionByName(top(rejected, "rejected"), allowMissingColumns=True)
