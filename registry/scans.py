"""Scans and sinks: the dirty orders written out in a format and read back."""

from pyspark.sql import functions as F

from lakestrata.operators.rules import date_range_filter
from lakestrata.session import work_folder
from lakestrata.sources import files, footers, sinks, tabular
from registry import register
from registry.dirty import Layers, layers_sql, raw_orders, raw_sql, table
from registry.folder import folder_sql, write_folder


def layouts_of(spark, folder, name_extra=False, canonical=None):
    """Listed CSV files of a folder with their layouts."""
    from lakestrata import constants as const
    listed = files.list_files(spark, folder)
    heads = files.sniff_layout(
        files.csv_heads(listed), canonical or const.HEADERLESS_NARROW, name_extra)
    return heads.join(listed.select("path", "file_name"), "path")


@register("scan_csv_declared", folder_sql("""
SELECT order_id, order_date, product, CAST(NULL AS DOUBLE) AS revenue FROM orders_rows
UNION ALL SELECT order_id, order_date, product, NULL FROM promo_rows"""))
def scan_csv_declared(spark, sf_dir):
    """Two header layouts under one declared schema, bound by name."""
    folder = write_folder(spark, sf_dir, ["orders", "promo"])
    return tabular.scan_csv_declared(spark, layouts_of(spark, folder))


@register("scan_csv_inferred", raw_sql("""
SELECT CAST(order_id AS BIGINT) AS order_id, customer_id, product, unit_price, CAST(quantity AS BIGINT) AS quantity,
       order_date, 'string' AS date_type, 'double' AS price_type FROM raw"""))
def scan_csv_inferred(spark, sf_dir):
    folder = work_folder(spark, "csv")
    raw_orders(spark, sf_dir).drop("k", "copy_no").write.option("header", True).csv(folder)
    rows = tabular.scan_csv_inferred(spark, folder)
    kinds = dict(rows.dtypes)
    return rows.withColumns({
        "order_id": F.col("order_id").cast("bigint"), "customer_id": F.col("customer_id").cast("bigint"),
        "quantity": F.col("quantity").cast("bigint"),
        "date_type": F.lit(kinds["order_date"]), "price_type": F.lit(kinds["unit_price"])})


@register("scan_json", folder_sql("""
SELECT order_id, order_date, product, round(unit_price * quantity, 2) AS revenue FROM blocks WHERE copy_no = 0
UNION ALL SELECT order_id, order_date, product, round(revenue, 2) FROM late_rows"""))
def scan_json(spark, sf_dir):
    """All orders: half of the files hold a record per line, half an array; the broken ones give nothing."""
    folder = write_folder(spark, sf_dir, ["lines", "late", "broken"])
    return tabular.scan_json(spark, folder).withColumn("revenue", F.round("revenue", 2))


@register("scan_parquet", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1, 2""")
def scan_parquet(spark, sf_dir):
    return tabular.scan_parquet(spark, f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@register("sink_parquet", raw_sql("SELECT * FROM raw"))
def sink_parquet(spark, sf_dir):
    folder = work_folder(spark, "parquet")
    sinks.write_parquet(raw_orders(spark, sf_dir), folder)
    sinks.write_parquet(raw_orders(spark, sf_dir), folder)
    return tabular.scan_parquet(spark, folder)


@register("gold_partitioned", layers_sql("""
SELECT CAST(CAST(order_date AS DATE) AS STRING) AS order_date, total_orders_per_day,
       round(total_revenue_per_day, 2) AS total_revenue_per_day
FROM gold WHERE CAST(order_date AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-03-31'"""))
def gold_partitioned(spark, sf_dir):
    """Daily gold in one folder per month; a date range reads only the folders it touches.

    Gold has a row per day, so folders per day would hold a row each.
    """
    folder = work_folder(spark, "gold")
    gold = Layers(spark, sf_dir).gold.withColumn("order_month", F.trunc("order_date", "month"))
    sinks.write_partitioned(gold, folder, by=["order_month"])
    months = date_range_filter(tabular.scan_parquet(spark, folder), "order_month", "1997-01-01", "1997-03-01")
    picked = date_range_filter(months, "order_date", "1997-01-01", "1997-03-31")
    return picked.select(
        F.col("order_date").cast("string").alias("order_date"), "total_orders_per_day",
        F.round("total_revenue_per_day", 2).alias("total_revenue_per_day"))


@register("csv_quoted_breaks", """SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
o_orderpriority || chr(10) || 'said "' || o_custkey || '",' || chr(10) AS note, CAST(o_custkey AS VARCHAR) AS customer_id FROM orders""")
def csv_quoted_breaks(spark, sf_dir):
    """Every order with line breaks, quotes and commas in a cell, read back in stretches that begin anywhere."""
    note = F.concat("o_orderpriority", F.lit('\nsaid "'), "o_custkey", F.lit('",\n'))
    folder = work_folder(spark, "breaks")
    table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), note.alias("note"), F.col("o_custkey").alias("customer_id")).write.csv(
            folder, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    columns = ["order_id", "note", "customer_id"]
    return tabular.scan_csv_layout(spark, folder, columns, True, multi_line=True, stretch=1 << 16).select(*columns)


@register("footer_totals", """SELECT o_orderpriority AS priority, count(*) AS rows, count(o_orderkey) AS order_id_held, min(o_orderkey) AS order_id_low,
max(o_orderkey) AS order_id_high, count(*) AS order_date_held, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS order_date_low,
CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS order_date_high, count(CASE WHEN o_orderkey % 37 <> 0 THEN 1 END) AS customer_held
FROM orders GROUP BY o_orderpriority""")
def footer_totals(spark, sf_dir):
    """Rows, days and keys of a partitioned table, told by the footers of its files."""
    folder = work_folder(spark, "footers")
    k = F.col("o_orderkey")
    sinks.write_partitioned(table(spark, sf_dir, "orders").select(
        k.alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(k % 37 != 0, F.col("o_custkey").cast("string")).alias("customer"), F.col("o_orderpriority").alias("priority")),
        folder, by=["priority"])
    found = footers.footer_totals(spark, folder, by=["priority"])
    return found.withColumns({name: F.col(name).cast("string") for name in ("order_date_low", "order_date_high")})
