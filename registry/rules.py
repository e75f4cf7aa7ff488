"""Predicates, quarantine rules and the issue list."""

from pyspark.sql import functions as F

from lakestrata.functions import predicates as p
from lakestrata.operators import rules as r
from registry import register
from registry.dirty import AS_OF, ORDER, Layers, layers_sql, raw_orders, raw_sql


@register("split_quarantine", raw_sql("""
SELECT k, copy_no, order_id IS NULL OR order_date IS NULL AS quarantined,
       CASE WHEN order_id IS NULL THEN 'null_order_id' WHEN order_date IS NULL THEN 'null_order_date' END AS reason
FROM raw"""))
def split_quarantine(spark, sf_dir):
    clean, bad = r.split_quarantine(raw_orders(spark, sf_dir), r.required_rules())
    return bad.select("k", "copy_no", F.lit(True).alias("quarantined"), F.col("rejection_reason").alias("reason")).unionByName(
        clean.select("k", "copy_no", F.lit(False).alias("quarantined"), F.lit(None).cast("string").alias("reason")))


@register("null_or_blank", raw_sql("""
SELECT k, copy_no, order_id IS NULL OR trim(order_id) = '' AS id_blank,
       order_date IS NULL OR trim(order_date) = '' AS date_blank,
       customer_id IS NULL AS customer_blank FROM raw"""))
def null_or_blank(spark, sf_dir):
    return raw_orders(spark, sf_dir).select(
        "k", "copy_no", p.is_blank("order_id").alias("id_blank"),
        p.is_blank("order_date").alias("date_blank"), p.is_blank("customer_id").alias("customer_blank"))


@register("range_check", raw_sql("""
SELECT k, copy_no, unit_price, quantity, quantity <= 0 AS quantity_not_positive, unit_price < 0 AS price_negative
FROM raw WHERE quantity <= 0 OR unit_price <= 0"""))
def range_check(spark, sf_dir):
    bad = p.is_not_positive("quantity") | p.is_not_positive("unit_price")
    return raw_orders(spark, sf_dir).where(bad).select(
        "k", "copy_no", "unit_price", "quantity", p.is_not_positive("quantity").alias("quantity_not_positive"),
        p.is_negative("unit_price").alias("price_negative"))


@register("date_validity", raw_sql("""
SELECT k, copy_no, order_date FROM raw WHERE try_cast(order_date AS DATE) IS NULL"""))
def date_validity(spark, sf_dir):
    return raw_orders(spark, sf_dir).where(p.is_bad_day("order_date")).select("k", "copy_no", "order_date")


@register("future_dates", raw_sql(f"""
SELECT k, copy_no, order_date, try_cast(order_date AS TIMESTAMP) > TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY AS live_rule
FROM raw WHERE try_cast(order_date AS DATE) > DATE '{AS_OF}'"""))
def future_dates(spark, sf_dir):
    return raw_orders(spark, sf_dir).where(p.is_after_day("order_date", AS_OF)).select(
        "k", "copy_no", "order_date", p.is_after_next_day("order_date", AS_OF).alias("live_rule"))


@register("date_range_filter", layers_sql("""
, days AS (SELECT CAST(order_date AS DATE) AS d, total_orders_per_day AS n FROM gold),
year_only AS (SELECT * FROM days WHERE d BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'),
one_day AS (SELECT * FROM days WHERE d = DATE '1998-06-15')
SELECT 'year' AS picked, CAST(d AS STRING) AS day, n AS orders FROM year_only
UNION ALL SELECT 'day', CAST(d AS STRING), n FROM one_day
UNION ALL SELECT 'fallback', CAST(d AS STRING), n FROM days"""))
def date_range_filter(spark, sf_dir):
    gold = Layers(spark, sf_dir).gold.select(
        F.col("order_date").cast("date").alias("date"), F.col("total_orders_per_day").alias("orders"))
    picks = {
        "year": r.date_range_filter(gold, year=1999),
        "day": r.date_range_filter(gold, start="1998-06-15"),
        # No data lies in this year, so the range falls back to all dates.
        "fallback": r.date_range_filter(gold, year=1900),
    }
    result = None
    for name, rows in picks.items():
        part = rows.select(F.lit(name).alias("picked"), F.col("date").cast("string").alias("day"), "orders")
        result = part if result is None else result.unionByName(part)
    return result


@register("rejection_reason", layers_sql("SELECT k, copy_no, rejection_reason FROM judged"))
def rejection_reason(spark, sf_dir):
    return r.with_rejection_reason(raw_orders(spark, sf_dir)).select("k", "copy_no", "rejection_reason")


@register("rejection_breakdown", layers_sql("""
SELECT rejection_reason AS reason, count(*) AS "count" FROM quarantine GROUP BY 1"""))
def rejection_breakdown(spark, sf_dir):
    return r.rejection_breakdown(r.with_rejection_reason(raw_orders(spark, sf_dir)))


VALIDATION_SQL = raw_sql(f"""
, firsts AS (
  SELECT *, count(*) OVER (PARTITION BY order_id) AS n,
         row_number() OVER (PARTITION BY order_id ORDER BY copy_no, k) AS rn
  FROM raw WHERE order_id IS NOT NULL),
issues AS (
SELECT order_id, n AS "Occurrences", product, order_date,
       'Duplicate Error: Found ' || n || ' entries for this ID. ' || (n - 1) || ' will be filtered.' AS "Reason"
FROM firsts WHERE rn = 1 AND n > 1
UNION ALL SELECT order_id, 1, product, order_date, 'Validation Failed: order_id is missing or null'
FROM raw WHERE order_id IS NULL OR order_id IN ('nan', '')
UNION ALL SELECT order_id, 1, product, order_date, 'Validation Failed: order_date is missing or null'
FROM raw WHERE order_date IS NULL OR order_date IN ('nan', '')
UNION ALL SELECT order_id, 1, product, order_date, 'Quality Alert: Negative value detected in quantity'
FROM raw WHERE quantity < 0
UNION ALL SELECT order_id, 1, product, order_date, 'Quality Alert: Negative value detected in unit_price'
FROM raw WHERE unit_price < 0
UNION ALL SELECT order_id, 1, product, order_date, 'Temporal Error: Record date is set in the future'
FROM raw WHERE try_cast(order_date AS TIMESTAMP) > TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY)
""")


@register("validation_frame", VALIDATION_SQL + "SELECT * FROM issues")
def validation_frame(spark, sf_dir):
    return r.validation_frame(raw_orders(spark, sf_dir), None, ORDER, AS_OF)


@register("issue_summary", VALIDATION_SQL + """
SELECT count(*) AS total, count(CASE WHEN contains("Reason", 'Duplicate') THEN 1 END) AS duplicate,
       count(CASE WHEN contains("Reason", 'Unsupported') THEN 1 END) AS unsupported,
       count(CASE WHEN contains("Reason", 'Negative') THEN 1 END) AS negative FROM issues""")
def issue_summary(spark, sf_dir):
    issues = r.validation_frame(raw_orders(spark, sf_dir), None, ORDER, AS_OF)
    return r.issue_summary(issues, ["Duplicate", "Unsupported", "Negative"])


@register("gold_from_clean_rows", layers_sql("""
SELECT order_date, total_orders_per_day, round(total_revenue_per_day, 2) AS total_revenue_per_day FROM gold"""))
def gold_from_clean_rows(spark, sf_dir):
    """Reason, split, one row per id, daily gold: the flagship chain."""
    gold = Layers(spark, sf_dir).gold
    return gold.withColumn("total_revenue_per_day", F.round("total_revenue_per_day", 2)).orderBy("order_date")
