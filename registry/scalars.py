"""Scalar expression families."""

from pyspark.sql import functions as F

from lakestrata.functions import parsing, text
from registry import register
from registry.dirty import table


@register("scalar_string", """
SELECT o_orderkey, lower(trim(' ' || o_orderpriority || ' ')) AS tidy, contains(o_orderpriority, 'HIGH') AS high,
       regexp_matches(o_orderpriority, '[0-9]-M') AS medium, format('{:,}', o_orderkey * 1000) AS grouped,
       'Found ' || o_custkey || ' entries' AS message,
       'orders_' || o_orderkey || '.csv' AS base_name, '.csv' AS extension
FROM orders""")
def scalar_string(spark, sf_dir):
    path = F.concat(F.lit("/data/in.put/orders_"), F.col("o_orderkey"), F.lit(".CSV"))
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lower(F.trim(F.concat(F.lit(" "), priority, F.lit(" ")))).alias("tidy"),
        priority.contains("HIGH").alias("high"), priority.rlike("[0-9]-M").alias("medium"),
        text.thousands(F.col("o_orderkey") * 1000).alias("grouped"),
        F.format_string("Found %d entries", "o_custkey").alias("message"),
        F.regexp_replace(text.file_name_of(path), "CSV$", "csv").alias("base_name"),
        text.extension_of(path).alias("extension"))


@register("scalar_date", """
SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS day, CAST(CAST(date_trunc('month', ts) AS DATE) AS STRING) AS month,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(ts, '%b %Y') AS label, strftime(ts, '%H:%M:%S') AS clock,
       CAST(CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS DATE) AS STRING) AS next_day,
       strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S') AS from_ms,
       try_cast(event_type AS DATE) IS NULL AS not_a_date
FROM events""")
def scalar_date(spark, sf_dir):
    from lakestrata import constants as const
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", parsing.as_day("ts").cast("string").alias("day"),
        F.trunc(parsing.as_day("ts"), "month").cast("string").alias("month"),
        F.date_format(ts, const.TIMESTAMP_FORMAT).alias("stamp"),
        F.date_format(ts, const.MONTH_FORMAT).alias("label"), F.date_format(ts, const.TIME_FORMAT).alias("clock"),
        F.date_add(parsing.as_day("ts"), 1).cast("string").alias("next_day"),
        F.date_format(F.timestamp_millis(F.unix_millis(ts.cast("timestamp"))), const.TIMESTAMP_FORMAT).alias("from_ms"),
        parsing.as_day("event_type").isNull().alias("not_a_date"))


@register("scalar_math", """
SELECT event_id, round(value / nullif(event_id % 7, 0), 4) AS ratio, CAST(format('{:.2f}', user_id * CAST(100 AS DOUBLE) / 400) AS DOUBLE) AS pct,
       CAST(round_even(value, 0) AS BIGINT) AS half_even, greatest(0, user_id - 50) AS above_fifty,
       CAST(user_id AS INTEGER) AS narrow, try_cast(event_type AS DOUBLE) IS NULL AS not_a_number,
       CASE WHEN value / nullif(event_id % 7, 0) IS NULL THEN '' ELSE format('{:+.1f}%', value) END AS label
FROM events""")
def scalar_math(spark, sf_dir):
    value, part = F.col("value"), (F.col("event_id") % 7).cast("double")
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(F.try_divide(value, part), 4).alias("ratio"),
        text.ratio_pct(F.col("user_id"), F.lit(400)).alias("pct"),
        F.bround(value, 0).cast("bigint").alias("half_even"),
        F.greatest(F.lit(0).cast("bigint"), F.col("user_id") - 50).alias("above_fifty"),
        F.col("user_id").cast("int").alias("narrow"), parsing.as_number("event_type").isNull().alias("not_a_number"),
        text.growth_label(F.when(part != 0, value)).alias("label"))
