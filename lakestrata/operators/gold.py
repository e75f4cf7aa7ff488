"""Daily and monthly gold aggregates, growth, funnel, summary and totals of date ranges."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata import constants as const
from lakestrata.functions.parsing import as_moment, as_number
from lakestrata.functions.text import growth_label
from lakestrata.operators.dedup import dedup_latest


def revenue_of(df: DataFrame) -> Column:
    """Revenue of a row: its column if there is one, else price times quantity, else zero."""
    zero = F.lit(0.0).cast("double")
    if "revenue" in df.columns:
        return F.coalesce(as_number("revenue"), zero)
    if {"unit_price", "quantity"} <= set(df.columns):
        return F.coalesce(as_number("unit_price") * as_number("quantity"), zero)
    return zero


def gold_daily(
    df: DataFrame, date: str | Column = "order_date", key: str = "order_id"
) -> DataFrame:
    """Orders (non-null ids) and revenue per day; rows without a day form no group."""
    day = F.col(date) if isinstance(date, str) else date
    return (
        df.select(day.alias("order_date"), F.col(key).alias("id"), revenue_of(df).alias("revenue"))
        .where(F.col("order_date").isNotNull())
        .groupBy("order_date")
        .agg(F.count("id").alias("total_orders_per_day"),
             F.sum("revenue").alias("total_revenue_per_day")))


def latest_dated(
    df: DataFrame, date: str = "order_date", key: str = "order_id",
    tiebreak: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Rows with a valid date, reduced to the newest per id; adds ``timestamp`` and ``date``."""
    dated = df.withColumn("timestamp", as_moment(date)).where(F.col("timestamp").isNotNull())
    return dedup_latest(dated, key, "timestamp", tiebreak).withColumn(
        "date", F.to_date("timestamp"))


def gold_daily_latest(
    df: DataFrame,
    date: str = "order_date",
    key: str = "order_id",
    tiebreak: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Per day: number of orders and newest time, after latest-wins deduplication. Always one row per day."""
    return (
        latest_dated(df, date, key, tiebreak).groupBy("date")
        .agg(F.count(F.lit(1)).alias("total_orders"),
             F.date_format(F.max("timestamp"), const.TIMESTAMP_FORMAT).alias("last_processed"))
        .orderBy("date"))


def gold_daily_ids(
    df: DataFrame,
    date: str = "order_date",
    key: str = "order_id",
    tiebreak: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The orders behind ``gold_daily_latest``: one row (date, order_id) per order, whatever the size of a day."""
    return latest_dated(df, date, key, tiebreak).select("date", F.col(key).cast("string").alias("order_id"))


def monthly_orders(daily: DataFrame, date: str = "date", orders: str = "total_orders") -> DataFrame:
    return daily.groupBy(F.trunc(date, "month").alias("month")).agg(
        F.sum(orders).alias("total_orders"))


def mom_growth(monthly: DataFrame, last: int | None = 3) -> DataFrame:
    """Growth against the previous month that exists; optionally only the last months.

    The windows run over months, whose number is bounded by the calendar, so one task is enough. The
    growth is taken before the cut, so the first shown month is compared with the one before it.
    """
    by_month = Window.orderBy("month")
    before = F.lag("total_orders").over(by_month)
    change = F.try_divide(
        (F.col("total_orders") - before).cast("double") * F.lit(100.0).cast("double"),
        before.cast("double"))
    grown = monthly.withColumn("growth_pct", change).withColumn(
        "month_label", F.date_format("month", const.MONTH_FORMAT)
    ).withColumn("growth_text", growth_label("growth_pct"))
    if last is None:
        return grown.orderBy("month")
    recent = F.row_number().over(Window.orderBy(F.desc("month")))
    return grown.withColumn("_n", recent).where(F.col("_n") <= last).drop("_n").orderBy("month")


def layer_funnel(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Bronze, rejected and silver counts in long form; a single ``Empty`` entry without bronze rows."""
    counts = bronze.agg(F.count(F.lit(1)).alias("b")).withColumn(
        "s", silver.agg(F.count(F.lit(1)).alias("s")).scalar())

    def stage(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("status"), value.cast("bigint").alias("count"))

    filled = F.array(
        stage("Bronze", F.col("b")),
        stage("Rejected", F.greatest(F.lit(0), F.col("b") - F.col("s"))),
        stage("Silver", F.col("s")))
    return counts.select(F.inline(
        F.when(F.col("b") == 0, F.array(stage("Empty", F.lit(1)))).otherwise(filled)))


def run_summary(
    files: DataFrame, bronze: DataFrame, silver: DataFrame, daily: DataFrame
) -> DataFrame:
    """One row: input files, raw and unique records, filtered duplicates and daily orders."""
    def count(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    orders = daily.agg(F.coalesce(F.sum("total_orders"), F.lit(0)).alias("n")).scalar()
    return files.agg(F.count(F.lit(1)).alias("files")).withColumns({
        "raw_records": count(bronze), "unique_records": count(silver), "daily_orders": orders,
    }).withColumn(
        "duplicates_filtered",
        F.greatest(F.lit(0), F.col("raw_records") - F.col("unique_records")))


def date_range_total(
    df: DataFrame, start: str, end: str, date: str = "date", orders: str | None = "total_orders"
) -> DataFrame:
    """One row: the first and last date there is, and the total within a range of dates."""
    day = F.col(date).cast("date")
    value = F.col(orders) if orders else F.lit(1)
    inside = day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return df.agg(
        F.min(day).alias("first_date"), F.max(day).alias("last_date"),
        F.coalesce(F.sum(F.when(inside, value)), F.lit(0)).alias("filtered_total"))


def preview(df: DataFrame, order_by: Sequence[str | Column], rows: int = 1000) -> DataFrame:
    """The first rows under an order (a top-n, so nothing is fully sorted)."""
    return df.orderBy(*order_by).limit(rows)
