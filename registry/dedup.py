"""Deduplication policies and duplicate reports."""

from pyspark.sql import functions as F

from lakestrata.functions.parsing import as_moment
from lakestrata.operators import dedup as d
from lakestrata.operators import quality as q
from registry import register
from registry.dirty import ORDER, raw_orders, raw_sql, table

DATA = ["order_id", "customer_id", "product", "unit_price", "quantity", "order_date"]


@register("dedup_full_row", raw_sql(f"SELECT DISTINCT {', '.join(DATA)} FROM raw"))
def dedup_full_row(spark, sf_dir):
    return d.dedup_full_row(raw_orders(spark, sf_dir).select(*DATA))


@register("dedup_by_key", raw_sql("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY copy_no, k) AS rn FROM raw) WHERE rn = 1"""))
def dedup_by_key(spark, sf_dir):
    return d.dedup_by_key(raw_orders(spark, sf_dir), order_by=ORDER)


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]


@register("dedup_lineitem", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CAST(CAST(l_shipdate AS DATE) AS STRING) AS shipped FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedup_lineitem(spark, sf_dir):
    first = d.dedup_composite(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return first.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        F.col("l_shipdate").cast("date").cast("string").alias("shipped"))


@register("dedup_composite", raw_sql("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, order_date ORDER BY copy_no, k) AS rn FROM raw)
WHERE rn = 1"""))
def dedup_composite(spark, sf_dir):
    return d.dedup_composite(raw_orders(spark, sf_dir), order_by=ORDER)


@register("dedup_latest", raw_sql("""
SELECT * EXCLUDE (rn, ts) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, copy_no, k) AS rn FROM (
    SELECT *, try_cast(order_date AS TIMESTAMP) AS ts FROM raw) WHERE ts IS NOT NULL)
WHERE rn = 1"""))
def dedup_latest(spark, sf_dir):
    dated = raw_orders(spark, sf_dir).withColumn("timestamp", as_moment("order_date"))
    return d.dedup_latest(dated.where("timestamp IS NOT NULL"), tiebreak=ORDER).drop("timestamp")


@register("duplicate_report", raw_sql("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, count(*) OVER (PARTITION BY order_id) AS "Occurrences",
         row_number() OVER (PARTITION BY order_id ORDER BY copy_no, k) AS rn
  FROM raw WHERE order_id IS NOT NULL) WHERE rn = 1 AND "Occurrences" > 1"""))
def duplicate_report(spark, sf_dir):
    return d.duplicate_report(raw_orders(spark, sf_dir), order_by=ORDER)


@register("duplicate_members", raw_sql("""
, groups AS (
  SELECT order_id, count(*) AS n, min(copy_no * 1000000000000 + k) AS pos FROM raw GROUP BY order_id HAVING count(*) > 1),
top AS (SELECT * FROM groups ORDER BY pos LIMIT 5)
SELECT count(*) AS ids, CAST(sum(n) AS BIGINT) AS members,
       (SELECT string_agg(coalesce(order_id, 'None'), ', ' ORDER BY pos) FROM top) AS sample_ids,
       ' … and ' || (count(*) - 5) || ' more' AS suffix FROM groups"""))
def duplicate_members(spark, sf_dir):
    return q.duplicate_members(raw_orders(spark, sf_dir), order_by=ORDER)


@register("duplicate_surplus", raw_sql("""
, ids AS (SELECT order_id, count(*) AS n FROM raw GROUP BY order_id)
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n) - count(*) AS BIGINT) AS surplus,
       CAST(format('{:.2f}', (sum(n) - count(*)) * CAST(100 AS DOUBLE) / sum(n)) AS DOUBLE) AS pct FROM ids"""))
def duplicate_surplus(spark, sf_dir):
    return q.duplicate_surplus(raw_orders(spark, sf_dir))
