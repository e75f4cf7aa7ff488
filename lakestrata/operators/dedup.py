"""Deduplication policies.

One row per key is ``row_number() = 1``: Spark then keeps one candidate row per key in every map task
before the shuffle (WindowGroupLimit), so a key that holds a large part of all rows never reaches one
task as a whole.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.constants import REQUIRED_COLUMNS

_RANK = "_survivor_rank"


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column]
) -> DataFrame:
    """The first row of each key under a total order. Null keys form one key."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def _order(df: DataFrame, order_by: Sequence[str | Column] | None) -> list[str | Column]:
    return list(order_by) if order_by else [F.col(f"`{name}`") for name in df.columns]


def dedup_full_row(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedup_by_key(
    df: DataFrame, key: str = "order_id", order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per key; without an order the whole row decides, so reruns agree."""
    return first_per_key(df, [key], _order(df, order_by))


def dedup_composite(
    df: DataFrame,
    keys: Sequence[str] = tuple(REQUIRED_COLUMNS),
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """First row per combination of the keys that exist; whole rows where none exists."""
    present = [key for key in keys if key in df.columns]
    if not present:
        return dedup_full_row(df)
    return first_per_key(df, present, _order(df, order_by))


def dedup_latest(
    df: DataFrame,
    key: str = "order_id",
    moment: str | Column = "timestamp",
    tiebreak: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The newest row per key."""
    newest = (F.col(moment) if isinstance(moment, str) else moment).desc()
    return first_per_key(df, [key], [newest, *_order(df, tiebreak)])


def repeated_keys(df: DataFrame, key: str = "order_id") -> DataFrame:
    """``_key`` (null included) and ``_n`` of the keys with more than one row; a hash aggregate of the key alone."""
    return df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)


def duplicate_report(
    df: DataFrame, key: str = "order_id", order_by: Sequence[str] | None = None
) -> DataFrame:
    """One sample row (the first) per repeated non-null key, with the number of its rows.

    Only rows of repeated keys go on from the count; of these each map task passes one per key.
    """
    order = list(order_by) if order_by else [F.col(f"`{c}`") for c in df.columns]
    repeated = repeated_keys(df.where(F.col(key).isNotNull()), key)
    rows = df.join(repeated.select("_key"), df[key] == F.col("_key"), "left_semi")
    return first_per_key(rows, [key], order).join(repeated, F.col(key) == F.col("_key")).select(
        *[F.col(f"`{c}`") for c in df.columns], F.col("_n").alias("Occurrences"))
