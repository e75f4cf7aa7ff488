"""Gold aggregates, growth, funnel and previews."""

from pyspark.sql import functions as F

from lakestrata.functions.parsing import as_day
from lakestrata.operators import gold as g
from lakestrata.session import work_folder
from lakestrata.sources import sinks
from lakestrata.sources.tabular import partition_scan
from registry import register
from registry.dirty import ORDER, Layers, layers_sql, raw_orders, raw_sql, table

LATEST_SQL = """
, dated AS (SELECT *, try_cast(order_date AS TIMESTAMP) AS ts FROM raw),
latest AS (
  SELECT *, CAST(ts AS DATE) AS d FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, copy_no, k) AS rn
    FROM dated WHERE ts IS NOT NULL) WHERE rn = 1),
daily AS (
  SELECT d, count(*) AS total_orders,
         strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_processed
  FROM latest GROUP BY d)
"""


@register("gold_daily", raw_sql("""
SELECT CAST(try_cast(order_date AS DATE) AS STRING) AS order_date, count(order_id) AS total_orders_per_day,
       round(sum(unit_price * quantity), 2) AS total_revenue_per_day
FROM raw WHERE try_cast(order_date AS DATE) IS NOT NULL GROUP BY 1"""))
def gold_daily(spark, sf_dir):
    """Straight from the dirty rows; ``gold_from_clean_rows`` has the whole chain."""
    gold = g.gold_daily(raw_orders(spark, sf_dir), as_day("order_date"))
    return gold.withColumns({
        "order_date": F.col("order_date").cast("string"),
        "total_revenue_per_day": F.round("total_revenue_per_day", 2)})


@register("gold_daily_ids", raw_sql(LATEST_SQL + "SELECT CAST(d AS STRING) AS date, order_id FROM latest"))
def gold_daily_ids(spark, sf_dir):
    gold = g.gold_daily_ids(raw_orders(spark, sf_dir), tiebreak=ORDER)
    return gold.withColumn("date", F.col("date").cast("string"))


@register("gold_daily_latest", raw_sql(LATEST_SQL + """
SELECT CAST(d AS STRING) AS date, total_orders, last_processed FROM daily"""))
def gold_daily_latest(spark, sf_dir):
    gold = g.gold_daily_latest(raw_orders(spark, sf_dir), tiebreak=ORDER)
    return gold.withColumn("date", F.col("date").cast("string"))


@register("monthly_orders", """
SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS STRING) AS month, count(*) AS total_orders
FROM orders GROUP BY 1""")
def monthly_orders(spark, sf_dir):
    return g.monthly_orders(_daily(spark, sf_dir)).withColumn("month", F.col("month").cast("string"))


def _daily(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.count(F.lit(1)).alias("total_orders"))


GROWTH_SQL = """
WITH months AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS n FROM orders GROUP BY 1),
grown AS (
  SELECT m, n, (n - lag(n) OVER (ORDER BY m)) * CAST(100 AS DOUBLE) / lag(n) OVER (ORDER BY m) AS growth,
         row_number() OVER (ORDER BY m DESC) AS rn FROM months)
SELECT CAST(m AS STRING) AS month, n AS total_orders, round(growth, 4) AS growth_pct,
       strftime(m, '%b %Y') AS month_label,
       CASE WHEN growth IS NULL THEN '' ELSE format('{:+.1f}%', growth) END AS growth_text
FROM grown"""


@register("mom_growth", GROWTH_SQL + " WHERE rn <= 3")
def mom_growth(spark, sf_dir):
    return _shown(g.mom_growth(g.monthly_orders(_daily(spark, sf_dir))))


@register("mom_growth_all", GROWTH_SQL)
def mom_growth_all(spark, sf_dir):
    return _shown(g.mom_growth(g.monthly_orders(_daily(spark, sf_dir)), last=None))


def _shown(growth):
    return growth.withColumns({
        "month": F.col("month").cast("string"), "growth_pct": F.round("growth_pct", 4)})


@register("layer_funnel", layers_sql("""
, n AS (SELECT (SELECT count(*) FROM raw) AS b, (SELECT count(*) FROM silver) AS s)
SELECT 'Bronze' AS status, b AS "count" FROM n UNION ALL SELECT 'Rejected', greatest(0, b - s) FROM n
UNION ALL SELECT 'Silver', s FROM n"""))
def layer_funnel(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    return g.layer_funnel(layers.raw, layers.silver)


@register("run_summary", layers_sql("""
, files AS (SELECT DISTINCT k // 2000 AS f FROM raw)
SELECT (SELECT count(*) FROM files) AS files, (SELECT count(*) FROM raw) AS raw_records,
       (SELECT count(*) FROM silver) AS unique_records,
       (SELECT count(*) FROM raw) - (SELECT count(*) FROM silver) AS duplicates_filtered,
       (SELECT CAST(sum(total_orders_per_day) AS BIGINT) FROM gold) AS daily_orders"""))
def run_summary(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    files = layers.raw.select(F.floor(F.col("k") / 2000).alias("file")).distinct()
    daily = layers.gold.withColumnRenamed("total_orders_per_day", "total_orders")
    return g.run_summary(files, layers.raw, layers.silver, daily)


@register("partition_scan_metrics", """
WITH months AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS n FROM orders GROUP BY 1),
s AS (
  SELECT count(*) AS total, count(CASE WHEN m BETWEEN DATE '1997-01-01' AND DATE '1997-12-01' THEN 1 END) AS inside,
         CAST(sum(CASE WHEN m BETWEEN DATE '1997-01-01' AND DATE '1997-12-01' THEN n END) AS BIGINT) AS filtered FROM months)
SELECT total AS total_partitions, inside AS partitions_scanned, filtered AS filtered_total,
       CAST(format('{:.2f}', inside * CAST(100 AS DOUBLE) / total) AS DOUBLE) AS scan_pct,
       CASE WHEN inside < total THEN 'PASS' ELSE 'ACTIVE' END AS pruning,
       (SELECT CAST(CAST(min(o_orderdate) AS DATE) AS STRING) FROM orders) AS first_date,
       (SELECT CAST(CAST(max(o_orderdate) AS DATE) AS STRING) FROM orders) AS last_date FROM s""")
def partition_scan_metrics(spark, sf_dir):
    """Daily counts in month folders: the folders that exist, and those a scan of one year opens."""
    folder = work_folder(spark, "daily")
    daily = _daily(spark, sf_dir).withColumn("month", F.trunc("date", "month"))
    sinks.write_partitioned(daily, folder, by=["month"])
    metrics = partition_scan(spark, folder, "month", "1997-01-01", "1997-12-01", "total_orders")
    bounds = g.date_range_total(_daily(spark, sf_dir), "1997-01-01", "1997-12-31")
    return metrics.withColumns({
        name: bounds.select(F.col(name).cast("string")).scalar() for name in ("first_date", "last_date")})


@register("date_range_total", """
SELECT CAST(CAST(min(o_orderdate) AS DATE) AS STRING) AS first_date, CAST(CAST(max(o_orderdate) AS DATE) AS STRING) AS last_date,
       count(CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' THEN 1 END) AS filtered_total
FROM orders""")
def date_range_total(spark, sf_dir):
    total = g.date_range_total(_daily(spark, sf_dir), "1997-01-01", "1997-12-31")
    return total.withColumns({name: F.col(name).cast("string") for name in ("first_date", "last_date")})


@register("preview_topn", raw_sql("SELECT * FROM raw ORDER BY copy_no, k LIMIT 1000"))
def preview_topn(spark, sf_dir):
    return g.preview(raw_orders(spark, sf_dir), ORDER)
