"""As-of join: the newest right record not later than each left record plus a tolerance."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.constants import ASOF_TOLERANCE_MS

BUCKET_MS = 3_600_000


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_ms: str = "timestamp",
    right_ms: str = "timestamp",
    right_order: str = "version",
    tolerance_ms: int = ASOF_TOLERANCE_MS,
    prefix: str = "q_",
) -> DataFrame:
    """Left rows with the columns of their right match (``prefix`` added), null where there is none.

    Times are whole milliseconds. Both sides are first reduced to distinct times, then placed in time
    buckets: a bucket holds at most one record per millisecond and side, however many rows share a
    time, so no bucket grows with the data. Within a bucket the match is a running last value; rows
    before the first right record of their bucket take the last one of the earlier buckets.
    """
    newest = right.groupBy(F.col(right_ms).alias("at")).agg(
        F.max_by(F.struct(*[F.col(c).alias(prefix + c) for c in right.columns]),
                 F.col(right_order)).alias("m"))
    times = left.where(F.col(left_ms).isNotNull()).select(F.col(left_ms).alias("lt")).distinct()
    reach = F.col("lt") + F.lit(tolerance_ms)
    kind = newest.schema["m"].dataType
    marks = newest.select(
        "at", F.lit(0).alias("side"), F.lit(None).cast("bigint").alias("lt"), "m"
    ).unionByName(times.select(
        reach.alias("at"), F.lit(1).alias("side"), "lt", F.lit(None).cast(kind).alias("m"))
    ).withColumn("bucket", F.floor(F.col("at") / F.lit(BUCKET_MS)))

    running = Window.partitionBy("bucket").orderBy("at", "side").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    inside = marks.withColumn("seen", F.last("m", ignorenulls=True).over(running)).where(
        F.col("side") == 1)
    # One row per bucket in use; the carried value is the newest match of all earlier buckets.
    ends = marks.groupBy("bucket").agg(F.max_by(
        "m", F.when(F.col("m").isNotNull(), F.col("at"))).alias("end"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("bucket", F.last("end", ignorenulls=True).over(earlier).alias("carry"))
    matched = inside.join(carried, "bucket").select(
        F.col("lt").alias("_lt"), F.coalesce("seen", "carry").alias("_m"))
    return left.join(matched, left[left_ms] == matched["_lt"], "left").select(
        *[left[c] for c in left.columns], F.col("_m.*"))


def accepted_vs_rejected(
    accepted: DataFrame, rejected: DataFrame, last: int | None = None,
    tolerance_ms: int = ASOF_TOLERANCE_MS,
) -> DataFrame:
    """Per accepted-table version: its rows and the rejected rows as of that time (0 if none yet).

    Both inputs are commit histories with ``version``, ``timestamp`` (ms) and ``total_rows``; no table
    data is read.
    """
    columns = ["version", "timestamp", "total_rows"]
    recent = accepted.select(*columns)
    if last is not None:
        recent = recent.orderBy(F.desc("version")).limit(last)
    joined = asof_join(recent, rejected.select(*columns), tolerance_ms=tolerance_ms)
    return joined.select(
        "version", "timestamp", F.col("total_rows").alias("clean_rows"),
        F.col("q_version").alias("rejected_version"),
        F.coalesce("q_total_rows", F.lit(0)).alias("rejected_rows"))


def rejected_ratio(clean: Column, rejected: Column) -> Column:
    return F.try_divide(rejected.cast("double"), (clean + rejected).cast("double"))
