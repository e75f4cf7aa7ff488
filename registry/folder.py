"""Input folders written from the dirty orders: one file per kind and block of orders.

File names follow from the order key, so the SQL of a query can name them too.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.session import work_folder
from registry.dirty import RAW_SQL, raw_orders
from registry.writing import json_array_lines, write_named_files

ORDERS_PER_FILE = 2000

V1 = ["order_id", "customer_id", "product_name", "unit_price", "quantity", "order_date"]
V2 = [*V1, "discount_code"]
QUANTITIES = ["5.0", "-2.0", "0.0", "abc", "1.5", "7"]

# Rows of the folder's files as SQL. ``seq`` orders the rows of a file.
FOLDER_SQL = RAW_SQL.rstrip() + f""",
blocks AS (SELECT *, lpad(CAST(k // {ORDERS_PER_FILE} AS VARCHAR), 6, '0') AS b FROM raw),
orders_rows AS (SELECT 'orders_' || b || '.csv' AS source_file, *, NULL AS discount_code FROM blocks WHERE copy_no = 0),
promo_rows AS (
  SELECT 'promo_' || b || '.csv' AS source_file, *,
         CASE WHEN k % 20 = 0 THEN 'SUMMER20' ELSE 'WELCOME10' END AS discount_code
  FROM blocks WHERE copy_no = 1),
late_rows AS (
  SELECT 'late_' || b || '.json' AS source_file, order_id, order_date, product,
         unit_price * quantity AS revenue, k, b
  FROM blocks WHERE copy_no = 2)
"""


def folder_sql(query: str) -> str:
    return FOLDER_SQL + query


def _block(kind: str, extension: str = "csv") -> Column:
    number = F.floor(F.col("k") / F.lit(ORDERS_PER_FILE)).cast("string")
    return F.concat(F.lit(f"{kind}_"), F.lpad(number, 6, "0"), F.lit(f".{extension}"))


def _headed(rows: DataFrame, kind: str, header: str | None, line: Column, seq: Column | None = None) -> DataFrame:
    """Lines of one kind of CSV file, each file under its header."""
    named = rows.withColumn("file_name", _block(kind))
    lines = named.select(
        "file_name", (F.col("k") if seq is None else seq).cast("bigint").alias("seq"), line.alias("line"))
    if header is None:
        return lines
    return lines.unionByName(named.select(
        "file_name", F.lit(-1).cast("bigint").alias("seq"), F.lit(header).alias("line")).distinct())


def _csv(*columns: Column | str) -> Column:
    return F.to_csv(F.struct(*columns))


def _orders(raw: DataFrame) -> DataFrame:
    return _headed(raw.where("copy_no = 0"), "orders", ",".join(V1), _csv(
        "order_id", "customer_id", "product", "unit_price", "quantity", "order_date"))


def _promo(raw: DataFrame) -> DataFrame:
    """A later layout with one more column; these files start with a byte order mark."""
    code = F.when(F.col("k") % 20 == 0, "SUMMER20").otherwise("WELCOME10")
    return _headed(raw.where("copy_no = 1"), "promo", "﻿" + ",".join(V2), _csv(
        "order_id", "customer_id", "product", "unit_price", "quantity", "order_date",
        code.alias("discount_code")))


def _late(raw: DataFrame) -> DataFrame:
    rows = raw.where("copy_no = 2")
    body = rows.select("order_id", "order_date", "product", (
        F.col("unit_price") * F.col("quantity")).alias("revenue"), "k")
    return json_array_lines(
        body, _block("late", "json"), ["order_id", "order_date", "product", "revenue"], ["k"])


def _broken(raw: DataFrame) -> DataFrame:
    """The late files without their closing bracket."""
    return _late(raw).where(F.col("line") != "]").withColumn(
        "file_name", F.regexp_replace("file_name", "^late", "broken"))


def _repeats(raw: DataFrame) -> DataFrame:
    """Every copied order three times in a file of its own."""
    rows = raw.where("copy_no = 1").withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return _headed(rows, "repeats", ",".join(V1), _csv(
        "order_id", "customer_id", "product", "unit_price", "quantity", "order_date"))


def _nulls(raw: DataFrame) -> DataFrame:
    """The orders that lack a required value, in a file of their own."""
    rows = raw.where("copy_no = 0 AND (order_id IS NULL OR order_date IS NULL)")
    return _headed(rows, "nulls", ",".join(V1), _csv(
        "order_id", "customer_id", "product", "unit_price", "quantity", "order_date"))


def _nodate(raw: DataFrame) -> DataFrame:
    return _headed(raw.where("copy_no = 2"), "nodate", "order_id,product", _csv("order_id", "product"))


def _narrow(raw: DataFrame) -> DataFrame:
    """No header, a single column."""
    return _headed(raw.where("copy_no = 2"), "narrow", None, F.col("k").cast("string"))


def _empty(raw: DataFrame) -> DataFrame:
    return raw.select(
        _block("empty").alias("file_name"), F.lit(0).cast("bigint").alias("seq"),
        F.lit(None).cast("string").alias("line")).distinct()


def _notes(raw: DataFrame) -> DataFrame:
    return raw.where("copy_no = 0").select(
        _block("notes", "txt").alias("file_name"), F.col("k").cast("bigint").alias("seq"),
        F.col("product").alias("line"))


def _lines(raw: DataFrame) -> DataFrame:
    """All orders as JSON: one record per line in every other file, arrays in the rest."""
    rows = raw.where("copy_no = 0").select("order_id", "order_date", "product", (
        F.col("unit_price") * F.col("quantity")).alias("revenue"), "k")
    odd = F.floor(F.col("k") / F.lit(ORDERS_PER_FILE)) % 2 == 1
    columns = ["order_id", "order_date", "product", "revenue"]
    line = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    by_line = rows.where(odd).select(_block("lines", "json").alias("file_name"), F.col("k").alias("seq"), line.alias("line"))
    return by_line.unionByName(json_array_lines(rows.where(~odd), _block("array", "json"), columns, ["k"]))


def _latin(raw: DataFrame) -> DataFrame:
    """Files with one byte that is not UTF-8, in the first record or in the last one."""
    rows = raw.where("copy_no = 2")
    block = F.floor(F.col("k") / F.lit(ORDERS_PER_FILE))
    place = F.when(block % 2 == 0, -F.col("k")).otherwise(F.col("k"))
    last = F.row_number().over(Window.partitionBy(block).orderBy(place.desc())) == 1
    name = F.when(last, F.lit("caf\u00e9")).otherwise(F.col("product"))
    return _headed(rows.withColumn("product", name), "latin", ",".join(V1), _csv(
        "order_id", "customer_id", "product", "unit_price", "quantity", "order_date"))


def _wide(raw: DataFrame) -> DataFrame:
    """A cell of 200,000 characters in the first record of each file."""
    rows = raw.where("copy_no = 2")
    block = F.floor(F.col("k") / F.lit(ORDERS_PER_FILE))
    first = F.row_number().over(Window.partitionBy(block).orderBy("k")) == 1
    name = F.when(first, F.repeat(F.lit("w"), 200_000)).otherwise(F.col("product"))
    return _headed(rows.withColumn("product", name), "wide", ",".join(V1), _csv(
        "order_id", "customer_id", "product", "unit_price", "quantity", "order_date"))


def _typed(raw: DataFrame) -> DataFrame:
    """Quantities as they come from spreadsheets; ids of their own."""
    quantity = F.element_at(F.array(*[F.lit(q) for q in QUANTITIES]), (F.col("k") % len(QUANTITIES) + 1).cast("int"))
    return _headed(raw.where("copy_no = 2"), "typed", ",".join(V1), _csv(
        F.concat(F.lit("t"), F.col("k")).alias("order_id"), "customer_id", "product", "unit_price",
        quantity.alias("quantity"), F.lit("2020-01-01").alias("order_date")))


def _under(raw: DataFrame) -> DataFrame:
    return _nodate(raw).withColumn("file_name", F.concat(F.lit("_"), F.col("file_name")))


def _plain(raw: DataFrame) -> DataFrame:
    """No header, seven columns. Valid dates come first: a first record that holds ``invalid-date``
    would be taken for a header."""
    rows = raw.where("copy_no = 0")
    later = F.when(F.col("order_date") == "invalid-date", 1_000_000_000_000).otherwise(0)
    return _headed(rows, "plain", None, _csv(
        "order_id", "customer_id", "product", "unit_price", "quantity", "order_date",
        F.lit("x").alias("tail")), F.col("k") + later)


def _ragged(raw: DataFrame) -> DataFrame:
    """Rows of five, six and seven cells under a header of six."""
    whole = _csv("order_id", "customer_id", "product", "unit_price", "quantity", "order_date")
    short = _csv("order_id", "customer_id", "product", "unit_price", "quantity")
    line = F.when(F.col("k") % 3 == 0, short).when(F.col("k") % 3 == 1, whole).otherwise(
        F.concat(whole, F.lit(",surplus")))
    return _headed(raw.where("copy_no = 0"), "ragged", ",".join(V1), line)


def _broken_lines(raw: DataFrame) -> DataFrame:
    """A line break inside the quoted product of every third order."""
    name = F.when(F.col("k") % 3 == 0, F.concat(F.lit('"two\nlines '), F.col("product"), F.lit('"'))).otherwise(
        F.col("product"))
    whole = F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in (
        F.col("order_id"), F.col("customer_id"), name, F.col("unit_price"), F.col("quantity"), F.col("order_date"))])
    return _headed(raw.where("copy_no = 1"), "breaks", ",".join(V1), whole)


def _odd(raw: DataFrame) -> DataFrame:
    """Untidy and repeated header names."""
    return _headed(raw.where("copy_no = 0"), "odd", " Order_ID ,DATE,Name,order_id,Product_Name", _csv(
        "order_id", "order_date", "product", F.lit("other").alias("x"), F.lit("second").alias("y")))


KINDS = {
    "orders": _orders, "promo": _promo, "late": _late, "broken": _broken, "repeats": _repeats,
    "nulls": _nulls, "nodate": _nodate, "narrow": _narrow, "empty": _empty, "notes": _notes,
    "plain": _plain, "ragged": _ragged, "odd": _odd, "lines": _lines, "latin": _latin, "wide": _wide,
    "typed": _typed, "under": _under, "breaks": _broken_lines,
}


def write_folder(spark: SparkSession, sf_dir: str, kinds: list[str], folder: str | None = None) -> str:
    """Write the given kinds of files into one folder and return its path."""
    folder = folder or work_folder(spark, "input")
    raw = raw_orders(spark, sf_dir)
    lines = None
    for kind in kinds:
        part = KINDS[kind](raw)
        lines = part if lines is None else lines.unionByName(part)
    write_named_files(lines, folder)
    return folder
