"""Session settings and the shared work folder."""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lakestrata.sources.storage import delete_folder

PARTITIONS_PER_CORE = 4
#: Work tables of local-mode sessions that do not name a folder.
LOCAL_WORK = "/tmp/checkpoints"


def build_session(app_name: str = "lakestrata", **extra: str) -> SparkSession:
    """A session with the settings the operators expect; ``extra`` overrides them.

    Unless the number of shuffle partitions is given, shuffles start with a few partitions per core.
    Adaptive execution merges small ones to the advisory size and splits skewed ones, so the number
    may be far too high for small data without harm.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(extra)
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if "spark.sql.shuffle.partitions" not in extra:
        start = max(200, PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(start))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    In local mode, where the tasks run inside the driver, there is a default. On a cluster it must be set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        named = f"{LOCAL_WORK}/{context.applicationId}"
    return named.rstrip("/")


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_folder(spark)}/lakestrata/{label}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, label: str, by: Sequence[str] = (), folder: str | None = None
) -> DataFrame:
    """``df`` written to the shared folder and read back, so later steps do not repeat its work.

    The written table also survives the loss of executors. ``by`` names partition columns.
    """
    folder = folder or work_folder(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def give_back(spark: SparkSession, folder: str) -> None:
    """Delete a work table that is not read any more."""
    delete_folder(spark, folder)


class Workspace:
    """Work tables of one run, deleted when it ends, also if it fails."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder = spark, work_folder(spark, label)

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *_) -> None:
        give_back(self.spark, self.folder)

    def table(self, df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
        return materialize(df, label, by, f"{self.folder}/{label}-{uuid.uuid4().hex}")
