"""Dirty orders: every row of ``orders`` with injected defects, copies and late corrections.

All orders are kept (copy 0). Some also come as an exact copy (1) or as a correction dated one day
later (2). The same derivation is given as SQL text, to be put in front of a query's SQL.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2026-03-14"

RAW_SQL = """
WITH base AS (
  SELECT CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS order_id,
         CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_custkey END AS customer_id,
         o_orderpriority AS product,
         CASE WHEN o_orderkey % 41 = 0 THEN -o_totalprice ELSE o_totalprice END AS unit_price,
         CASE WHEN o_orderkey % 43 = 0 THEN 0 ELSE 1 + o_orderkey % 5 END AS quantity,
         CASE WHEN o_orderkey % 53 = 0 THEN 'invalid-date'
              WHEN o_orderkey % 59 = 0 THEN NULL
              WHEN o_orderkey % 61 = 0 THEN '2999-01-01'
              ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
         o_orderkey AS k, 0 AS copy_no
  FROM orders),
late AS (
  SELECT order_id, customer_id, product, unit_price, quantity,
         CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS DATE) AS STRING) AS order_date, k, 2 AS copy_no
  FROM base JOIN orders ON k = o_orderkey WHERE k % 15 = 0),
raw AS (
  SELECT order_id, customer_id, product, unit_price, quantity, order_date, k, copy_no FROM base
  UNION ALL SELECT order_id, customer_id, product, unit_price, quantity, order_date, k, 1 FROM base WHERE k % 10 = 0
  UNION ALL SELECT order_id, customer_id, product, unit_price, quantity, order_date, k, copy_no FROM late)
"""

REASON_SQL = """CASE WHEN order_id IS NULL OR trim(order_id) = '' THEN 'null_order_id'
       WHEN order_date IS NULL OR trim(order_date) = '' THEN 'null_order_date'
       WHEN quantity <= 0 THEN 'non_positive_quantity'
       WHEN unit_price <= 0 THEN 'non_positive_unit_price'
       WHEN try_cast(order_date AS DATE) IS NULL THEN 'invalid_order_date' END"""

LAYERS_SQL = RAW_SQL.rstrip() + f""",
judged AS (SELECT *, {REASON_SQL} AS rejection_reason FROM raw),
quarantine AS (SELECT * FROM judged WHERE rejection_reason IS NOT NULL),
validated AS (SELECT * EXCLUDE (rejection_reason) FROM judged WHERE rejection_reason IS NULL),
silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY copy_no, k) AS rn FROM validated)
  WHERE rn = 1),
gold AS (
  SELECT order_date, count(order_id) AS total_orders_per_day,
         sum(unit_price * quantity) AS total_revenue_per_day
  FROM silver GROUP BY order_date)
"""


def raw_sql(query: str) -> str:
    """``query`` over the dirty orders; it starts with SELECT, or with a comma and more CTEs."""
    return RAW_SQL + query


def layers_sql(query: str) -> str:
    return LAYERS_SQL + query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty orders in one scan: the copies of a row come from exploding a short array."""
    k = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    copies = F.array_compact(F.array(
        F.lit(0), F.when(k % 10 == 0, 1), F.when(k % 15 == 0, 2)))
    dated = (
        F.when(F.col("copy_no") == 2, F.date_add(day, 1).cast("string"))
        .when(k % 53 == 0, "invalid-date")
        .when(k % 59 == 0, F.lit(None).cast("string"))
        .when(k % 61 == 0, "2999-01-01")
        .otherwise(day.cast("string")))
    return table(spark, sf_dir, "orders").withColumn("copy_no", F.explode(copies)).select(
        F.when(k % 67 != 0, k.cast("string")).alias("order_id"),
        F.when(k % 37 != 0, F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderpriority").alias("product"),
        F.when(k % 41 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("unit_price"),
        F.when(k % 43 == 0, F.lit(0).cast("bigint")).otherwise(1 + k % 5).alias("quantity"),
        dated.alias("order_date"),
        k.alias("k"), "copy_no")


ORDER = ["copy_no", "k"]


class Layers:
    """The dirty orders and the layers derived from them, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        from lakestrata.operators.columns import add_processing_time
        from lakestrata.operators.dedup import dedup_by_key
        from lakestrata.operators.gold import gold_daily
        from lakestrata.operators.rules import split_quarantine

        self.raw = raw_orders(spark, sf_dir)
        self.validated, self.quarantine = split_quarantine(self.raw)
        self.silver = dedup_by_key(self.validated, order_by=ORDER)
        self.gold = gold_daily(self.silver)
        stamp = {"ingestion_timestamp": F.current_timestamp(), "source_file": F.lit("orders")}
        self.tables = {
            "bronze": self.raw.withColumns(stamp),
            "quarantine": self.quarantine.withColumns(stamp),
            "validated": self.validated.withColumns(stamp),
            "silver": add_processing_time(self.silver.withColumns(stamp)),
            "gold": self.gold,
        }
