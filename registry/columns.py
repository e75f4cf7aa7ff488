"""Column operators."""

from pyspark.sql import functions as F

from lakestrata.operators import columns as c
from registry import register
from registry.dirty import AS_OF, raw_orders, raw_sql, table

VENDOR_NAMES = {
    "order_id": " ID ", "order_date": "Event_Timestamp", "product": "Product_Name",
    "unit_price": "Price", "quantity": "quantity"}


def vendor_orders(spark, sf_dir):
    """The dirty orders under a supplier's own column names."""
    raw = raw_orders(spark, sf_dir)
    return raw.select(*[F.col(old).alias(new) for old, new in VENDOR_NAMES.items()], "k", "copy_no")


@register("add_audit_columns", raw_sql("""
SELECT k, copy_no, TRUE AS stamped, 'orders.parquet' AS source_file FROM raw"""))
def add_audit_columns(spark, sf_dir):
    orders = c.add_source_file(table(spark, sf_dir, "orders"))
    copies = F.array_compact(F.array(
        F.lit(0), F.when(F.col("o_orderkey") % 10 == 0, 1), F.when(F.col("o_orderkey") % 15 == 0, 2)))
    stamped = c.add_processing_time(orders).withColumn("copy_no", F.explode(copies))
    return stamped.select(
        F.col("o_orderkey").alias("k"), "copy_no",
        F.col("processing_timestamp").isNotNull().alias("stamped"), "source_file")


@register("normalize_headers", raw_sql("""
SELECT order_id AS id, order_date AS event_timestamp, product AS product_name, unit_price AS price,
       quantity, k, copy_no FROM raw"""))
def normalize_headers(spark, sf_dir):
    vendor = vendor_orders(spark, sf_dir)
    repeated = vendor.withColumn("again", F.col("Price") + 1)
    return c.normalize_headers(repeated, [*vendor.columns, "PRICE "])


@register("alias_columns", raw_sql("""
SELECT order_id, order_date, product, unit_price AS revenue, quantity, k, copy_no FROM raw"""))
def alias_columns(spark, sf_dir):
    tidy = c.normalize_headers(vendor_orders(spark, sf_dir))
    collided = tidy.withColumn("name", F.lit("loses to product_name"))
    return c.pick_aliases(c.alias_columns(collided))


@register("detect_date_column", raw_sql("""
SELECT 'ordered_on' AS detected, count(*) AS rows_read,
       count(CASE WHEN regexp_matches(order_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN 1 END) AS dated_rows
FROM raw"""))
def detect_date_column(spark, sf_dir):
    raw = raw_orders(spark, sf_dir).withColumnRenamed("order_date", "ordered_on")
    found = c.detect_date_column(raw)
    return raw.agg(
        F.lit(found).alias("detected"), F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col(found).rlike(r"\d{4}-\d{2}-\d{2}")).alias("dated_rows"))


@register("project_existing", raw_sql("SELECT order_id, order_date, unit_price, quantity, k, copy_no FROM raw"))
def project_existing(spark, sf_dir):
    return c.project_existing(
        raw_orders(spark, sf_dir),
        ["order_id", "order_date", "revenue", "unit_price", "quantity", "k", "copy_no"])


@register("default_columns", raw_sql(f"""
SELECT order_id, '{AS_OF}' AS order_date, CAST(0.0 AS DOUBLE) AS revenue, quantity, k, copy_no FROM raw"""))
def default_columns(spark, sf_dir):
    rows = raw_orders(spark, sf_dir).select("order_id", "quantity", "k", "copy_no")
    filled = c.with_defaults(rows, {
        "order_date": F.to_date(F.lit(AS_OF)), "revenue": F.lit(0.0).cast("double"), "quantity": 0})
    return filled.withColumn("order_date", F.col("order_date").cast("string"))


@register("normalize_gold", raw_sql("""
, daily AS (
  SELECT order_date, CAST(count(order_id) AS INTEGER) AS n, CAST(sum(quantity) AS DOUBLE) AS r
  FROM raw GROUP BY order_date)
SELECT CAST(try_cast(order_date AS DATE) AS STRING) AS date, n AS total_orders, r AS total_revenue
FROM daily WHERE try_cast(order_date AS DATE) IS NOT NULL"""))
def normalize_gold(spark, sf_dir):
    from lakestrata.operators.gold import gold_daily
    # Whole numbers as revenue: they stay exact in the narrow type.
    priced = raw_orders(spark, sf_dir).withColumn("revenue", F.col("quantity").cast("double"))
    gold = c.normalize_gold(gold_daily(priced))
    return gold.select(
        F.col("date").cast("date").cast("string").alias("date"), "total_orders",
        F.col("total_revenue").cast("double").alias("total_revenue"))


@register("fill_constant", raw_sql("""
SELECT coalesce(order_id, 'unknown') AS order_id, coalesce(customer_id, 0) AS customer_id, k, copy_no
FROM raw"""))
def fill_constant(spark, sf_dir):
    return c.fill_constant(
        raw_orders(spark, sf_dir), {"customer_id": 0, "order_id": "unknown"}
    ).select("order_id", "customer_id", "k", "copy_no")


@register("fill_mean", raw_sql("""
, mean AS (SELECT CAST(round_even(avg(customer_id), 0) AS BIGINT) AS m FROM raw)
SELECT coalesce(customer_id, m) AS customer_id, k, copy_no FROM raw, mean"""))
def fill_mean(spark, sf_dir):
    return c.fill_mean(raw_orders(spark, sf_dir), "customer_id").select("customer_id", "k", "copy_no")
