"""File streams: every new file is taken exactly once, files that hold nothing included."""

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakestrata.plans.batch import Medallion
from lakestrata.plans.live import examine, read_files
from lakestrata.session import Workspace
from lakestrata.sources import files as files_
from lakestrata.sources.runs import RunTable
from lakestrata.sources.tabular import POSITION
from lakestrata.streaming.arrivals import folder_stream


def _trigger(writer, interval: str | None):
    """Drain what is there and stop, or poll at an interval."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def _names(files: DataFrame, at_once: int | None) -> Iterator[list[str]]:
    """The names of files in order, so many at a time, as scans need them on the driver."""
    paths = files.select("path").orderBy("path").toArrow().column("path").to_pylist()
    step = at_once or max(len(paths), 1)
    for at in range(0, len(paths), step):
        yield paths[at:at + step]


class BronzeTables:
    """``root/bronze`` (rows as text), ``root/issues`` and ``root/handled``, the files that were taken; all by run.

    A run writes ``handled`` last, in one file; rows and issues of a run that did not come so far are in no reading.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.handled = spark, RunTable(spark, f"{root}/handled")
        self.bronze, self.issues = (RunTable(spark, f"{root}/{name}", self.recorded) for name in ("bronze", "issues"))

    def recorded(self) -> DataFrame:
        return self.handled.runs() if self.handled.exists() else self.spark.createDataFrame([], "run string")

    def new_files(self, listed: DataFrame) -> DataFrame:
        return files_.pending_files(listed, self.handled.read()) if self.handled.exists() else listed


def ingest_stream(
    spark: SparkSession, input_path: str, root: str, checkpoint: str,
    interval: str | None = None, files_per_batch: int | None = None, **options,
) -> StreamingQuery:
    """New files into ``root/bronze`` as text, and what is wrong with files into ``root/issues``.

    A micro-batch reads its new files by their own layouts and writes by name, so a column that comes late is null
    before, and a file that cannot be read, or holds nothing, is an issue and stops nothing. What was taken is recorded
    when all of it is written, so a batch that is played again takes only what is not recorded. All files that have come
    are taken at once, as a take has a price of its own, whatever it holds, unless ``files_per_batch`` says how many.
    """
    tables = BronzeTables(spark, root)

    def take(paths: list[str]) -> None:
        run = uuid.uuid4().hex
        with Workspace(spark, "ingest") as work:
            taken = work.table(files_.named_files(spark, paths), "files")
            examined, records = examine(taken, keep=work.table)
            found = files_.file_issues(examined)
            if not found.isEmpty():
                tables.issues.write(found, run)
            rows = read_files(spark, examined.where(F.col("issue").isNull()), records, **options)
            if rows is not None:
                tables.bronze.write(rows.drop("source_path", *POSITION).withColumn(
                    "ingestion_timestamp", F.current_timestamp()), run)
            tables.handled.write(taken.select(*files_.FILE_KEY).coalesce(1), run)

    def handle(batch: DataFrame, batch_id: int) -> None:
        listed = files_.named_files(spark, [name for part in _names(batch, None) for name in part])
        for paths in _names(tables.new_files(listed), files_per_batch):
            take(paths)

    writer = folder_stream(spark, input_path).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def medallion_stream(
    spark: SparkSession, input_path: str, root: str, checkpoint: str,
    interval: str | None = None, files_per_batch: int | None = None,
    **options,
) -> StreamingQuery:
    """Each micro-batch of new files runs through the batch medallion.

    The stream only tells that the folder has changed and what it holds; the manifest, not the stream's own state,
    decides which files are new. Every file gets a disposition, whatever its size and name. All new files are one run of
    the medallion, unless ``files_per_batch`` says how many.
    """
    medallion = Medallion(spark, root)

    def handle(batch: DataFrame, batch_id: int) -> None:
        listed = files_.named_files(spark, [name for part in _names(batch, None) for name in part])
        pending = files_.pending_files(listed, files_.read_manifest(spark, medallion.manifest))
        for paths in _names(pending, files_per_batch):
            medallion.run(paths, **options)

    writer = folder_stream(spark, input_path).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()
