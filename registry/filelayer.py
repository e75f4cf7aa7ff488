"""File layer: routing, header recognition, ragged rows, evolution, issues, gate, manifest, whole runs."""

from pyspark.sql import functions as F

from lakestrata import constants as const
from lakestrata.operators import rules as r
from lakestrata.plans.batch import Medallion
from lakestrata.plans.cleaning import clean_job
from lakestrata.plans.cleaning import daily_gold_job as daily_gold_job_
from lakestrata.plans.live import examine, read_files
from lakestrata.plans.live import gold_live as gold_live_
from lakestrata.plans.live import medallion_live as medallion_live_
from lakestrata.session import work_folder
from lakestrata.sources import files, tabular
from registry import register
from registry.dirty import raw_orders, raw_sql
from registry.folder import QUANTITIES, V1, V2, folder_sql, write_folder
from registry.scans import layouts_of

ALL_KINDS = ["orders", "promo", "late", "broken", "repeats", "nulls", "nodate", "narrow", "empty", "notes"]


def _names(kind: str, where: str, extension: str = "csv") -> str:
    """SQL for the distinct file names of one kind."""
    return f"SELECT DISTINCT '{kind}_' || b || '.{extension}' AS file_name FROM blocks WHERE {where}"


_NULL_ROWS = "copy_no = 0 AND (order_id IS NULL OR order_date IS NULL)"

FILES_SQL = folder_sql(f"""
, listed AS (
  {_names('orders', 'copy_no = 0')} UNION ALL {_names('promo', 'copy_no = 1')}
  UNION ALL {_names('late', 'copy_no = 2', 'json')} UNION ALL {_names('broken', 'copy_no = 2', 'json')}
  UNION ALL {_names('repeats', 'copy_no = 1')} UNION ALL {_names('nulls', _NULL_ROWS)}
  UNION ALL {_names('nodate', 'copy_no = 2')} UNION ALL {_names('narrow', 'copy_no = 2')}
  UNION ALL {_names('empty', 'copy_no = 0')} UNION ALL {_names('notes', 'copy_no = 0', 'txt')}),
kinds AS (SELECT file_name, split_part(file_name, '_', 1) AS kind, '.' || split_part(file_name, '.', 2) AS extension FROM listed)
""")


@register("file_routing", FILES_SQL + """
SELECT file_name, extension, extension IN ('.csv', '.json') AS supported FROM kinds""")
def file_routing(spark, sf_dir):
    folder = write_folder(spark, sf_dir, ALL_KINDS)
    return files.list_files(spark, folder).select("file_name", "extension", "supported")


@register("header_sniff", FILES_SQL + f"""
SELECT file_name, kind <> 'narrow' AND kind <> 'empty' AS has_header,
       CASE kind WHEN 'promo' THEN '{",".join(V2)}' WHEN 'nodate' THEN 'order_id,product'
                 WHEN 'narrow' THEN '{",".join(const.HEADERLESS_NARROW)}' WHEN 'empty' THEN NULL
                 ELSE '{",".join(V1)}' END AS columns
FROM kinds WHERE extension = '.csv'""")
def header_sniff(spark, sf_dir):
    folder = write_folder(spark, sf_dir, ALL_KINDS)
    return layouts_of(spark, folder).select(
        "file_name", "has_header", F.array_join("columns", ",").alias("columns"))


@register("headerless_naming", folder_sql("""
SELECT 'plain_' || b || '.csv' AS source_file, order_id, CAST(customer_id AS VARCHAR) AS customer_id, product,
       unit_price, CAST(quantity AS VARCHAR) AS quantity, order_date, 'x' AS extra_col_1
FROM blocks WHERE copy_no = 0"""))
def headerless_naming(spark, sf_dir):
    folder = write_folder(spark, sf_dir, ["plain"])
    layouts = layouts_of(spark, folder, name_extra=True, canonical=const.HEADERLESS_WIDE)
    return priced(tabular.scan_csv_files(spark, layouts).drop("source_path"))


def priced(rows):
    """Text rows with the price as a number, so that its spelling does not matter."""
    return rows.withColumn("unit_price", F.col("unit_price").cast("double"))


_RAGGED = """order_id, CAST(customer_id AS VARCHAR) AS customer_id, product, unit_price,
  CAST(quantity AS VARCHAR) AS quantity, CASE WHEN k % 3 = 0 THEN NULL ELSE order_date END AS order_date"""


@register("ragged_rows", folder_sql(f"""
SELECT 'pad' AS mode, {_RAGGED} FROM blocks WHERE copy_no = 0
UNION ALL SELECT 'skip', {_RAGGED} FROM blocks WHERE copy_no = 0 AND k % 3 <> 2
UNION ALL SELECT 'breaks', order_id, CAST(customer_id AS VARCHAR),
  CASE WHEN k % 3 = 0 THEN 'two' || chr(10) || 'lines ' || product ELSE product END, unit_price,
  CAST(quantity AS VARCHAR), order_date FROM blocks WHERE copy_no = 1"""))
def ragged_rows(spark, sf_dir):
    """Short and over-long rows, and cells with line breaks, which are found and read without being asked for."""
    columns = ["order_id", "customer_id", "product", "unit_price", "quantity", "order_date"]
    layouts = layouts_of(spark, write_folder(spark, sf_dir, ["ragged"]))
    frames = [
        tabular.scan_csv_files(spark, layouts, ragged=mode).select(F.lit(mode).alias("mode"), *columns)
        for mode in ("pad", "skip")]
    examined, records = examine(files.list_files(spark, write_folder(spark, sf_dir, ["breaks"])))
    frames.append(read_files(spark, examined, records).select(F.lit("breaks").alias("mode"), *columns))
    return priced(tabular.union_by_name(frames))


@register("untidy_headers", folder_sql("""
SELECT order_id, order_date, product, 'odd_' || b || '.csv' AS source_file FROM blocks WHERE copy_no = 0"""))
def untidy_headers(spark, sf_dir):
    """Names to trim, a repeated name, and two names with one alias: the first wins each time."""
    folder = write_folder(spark, sf_dir, ["odd"])
    return tabular.scan_csv_files(spark, layouts_of(spark, folder)).drop("source_path")


@register("schema_evolution_union", folder_sql("""
, all_rows AS (SELECT * FROM orders_rows UNION ALL SELECT * FROM promo_rows)
SELECT source_file, order_id, CAST(customer_id AS VARCHAR) AS customer_id, product, unit_price,
       CAST(quantity AS VARCHAR) AS quantity, order_date, discount_code FROM all_rows"""))
def schema_evolution_union(spark, sf_dir):
    folder = write_folder(spark, sf_dir, ["orders", "promo"])
    return priced(tabular.scan_csv_files(spark, layouts_of(spark, folder)).drop("source_path"))


@register("required_columns", FILES_SQL + """
SELECT file_name, CASE WHEN kind = 'nodate' THEN 'order_date' ELSE '' END AS missing
FROM kinds WHERE extension = '.csv' AND kind NOT IN ('empty', 'narrow')""")
def required_columns(spark, sf_dir):
    folder = write_folder(spark, sf_dir, ALL_KINDS)
    headed = layouts_of(spark, folder).where(F.col("has_header"))
    return headed.select("file_name", F.array_join(
        files.missing_required(F.col("columns")), ",").alias("missing"))


@register("file_issues", FILES_SQL + f"""
SELECT file_name AS source_file, 'N/A' AS order_date, 'N/A' AS product, 'PARSE_ERROR' AS order_id,
  'Corrupted CSV: {files.NOT_UTF8}' AS "Reason" FROM ({_names('latin', 'copy_no = 2')})
UNION ALL SELECT '_nodate_' || b || '.csv', 'N/A', 'N/A', 'IO_ERROR',
  'Access Error: File could not be read. Error: {files.HIDDEN_NAME}' FROM (SELECT DISTINCT b FROM blocks WHERE copy_no = 2)
UNION ALL SELECT * FROM (SELECT file_name AS source_file, 'N/A' AS order_date, 'N/A' AS product,
  CASE kind WHEN 'notes' THEN 'N/A' WHEN 'broken' THEN 'CRITICAL' WHEN 'empty' THEN 'EMPTY'
            WHEN 'narrow' THEN 'PARSE_ERROR' WHEN 'nodate' THEN 'SCHEMA_ERROR' END AS order_id,
  CASE kind WHEN 'notes' THEN 'Unsupported File Format: File extension ''.txt'' is not supported. Use .csv or .json only.'
            WHEN 'broken' THEN 'Corrupted JSON: File could not be parsed. Error: malformed record'
            WHEN 'empty' THEN 'Corrupted Data: File is empty or has no rows.'
            WHEN 'narrow' THEN 'Corrupted CSV: Inconsistent columns: Expected at least 2 (order_id, order_date), found 1'
            WHEN 'nodate' THEN 'Validation Failed: Missing required columns (order_id, order_date).' END AS "Reason"
  FROM kinds) AS i WHERE order_id IS NOT NULL""")
def file_issues(spark, sf_dir):
    """Also bytes that are not UTF-8 early and late in a file, a very wide cell (no issue), and a name with ``_``."""
    folder = write_folder(spark, sf_dir, [*ALL_KINDS, "latin", "wide", "under"])
    examined, _ = examine(files.list_files(spark, folder))
    return files.file_issues(examined)


@register("file_threshold_gate", folder_sql(f"""
, all_rows AS (
  SELECT 'orders_' || b || '.csv' AS f, {', '.join(c for c in ('order_id', 'customer_id', 'product', 'unit_price', 'quantity', 'order_date'))}
  FROM blocks WHERE copy_no = 0
  UNION ALL SELECT 'repeats_' || b || '.csv', order_id, customer_id, product, unit_price, quantity, order_date
  FROM blocks, range(3) WHERE copy_no = 1
  UNION ALL SELECT 'nulls_' || b || '.csv', order_id, customer_id, product, unit_price, quantity, order_date
  FROM blocks WHERE {_NULL_ROWS}),
copies AS (SELECT f, order_id, order_date, count(*) AS n FROM all_rows
           GROUP BY f, order_id, customer_id, product, unit_price, quantity, order_date),
ratios AS (
  SELECT f, CAST(sum(n) AS BIGINT) AS total_rows, (sum(n) - count(*)) / CAST(sum(n) AS DOUBLE) AS dup_ratio,
         sum(CASE WHEN order_id IS NULL OR order_date IS NULL THEN n ELSE 0 END) / CAST(sum(n) AS DOUBLE) AS null_ratio
  FROM copies GROUP BY f)
SELECT f AS source_file, total_rows, round(dup_ratio, 8) AS dup_ratio, round(null_ratio, 8) AS null_ratio,
       CASE WHEN dup_ratio > 0.5 THEN 'duplicate_ratio' WHEN null_ratio > 0.5 THEN 'null_ratio' END AS reason,
       CASE WHEN dup_ratio > 0.5 OR null_ratio > 0.5 THEN 'rejected' ELSE 'processed' END AS disposition
FROM ratios"""))
def file_threshold_gate(spark, sf_dir):
    folder = write_folder(spark, sf_dir, ["orders", "repeats", "nulls"])
    rows = tabular.scan_csv_files(spark, layouts_of(spark, folder)).drop("source_path")
    return r.file_threshold_gate(rows).withColumns({
        "dup_ratio": F.round("dup_ratio", 8), "null_ratio": F.round("null_ratio", 8)})


def _issue_text(issue, *values):
    return (issue[1] % values if values else issue[1]).replace("'", "''")


@register("file_manifest", FILES_SQL + f"""
SELECT file_name, CASE WHEN kind = 'notes' THEN 'unsupported' WHEN kind IN ('orders', 'promo', 'late') THEN 'processed'
                       ELSE 'rejected' END AS disposition,
  CASE kind WHEN 'repeats' THEN 'duplicate_ratio' WHEN 'nulls' THEN 'null_ratio'
    WHEN 'notes' THEN '{_issue_text(const.ISSUE_UNSUPPORTED, '.txt')}'
    WHEN 'broken' THEN '{_issue_text(const.ISSUE_BAD_JSON, 'malformed record')}'
    WHEN 'empty' THEN '{_issue_text(const.ISSUE_EMPTY)}' WHEN 'nodate' THEN '{_issue_text(const.ISSUE_SCHEMA)}'
    WHEN 'narrow' THEN '{_issue_text(const.ISSUE_BAD_CSV, const.ISSUE_TOO_NARROW % 1)}' END AS reason,
  CASE WHEN kind = 'narrow' THEN 2 ELSE 1 END AS entries FROM kinds
UNION ALL SELECT '_nodate_' || b || '.csv', 'rejected', '{_issue_text(const.ISSUE_UNREADABLE, files.HIDDEN_NAME)}', 1
FROM (SELECT DISTINCT b FROM blocks WHERE copy_no = 2)""")
def file_manifest(spark, sf_dir):
    """Half of the files arrive first, the rest later; each is handled once. Some names are delivered again."""
    folder, root = work_folder(spark, "input"), work_folder(spark, "medallion")
    medallion = Medallion(spark, root)
    for kinds in (ALL_KINDS[:5], [*ALL_KINDS[5:], "under"], None, ["narrow"]):
        if kinds:
            write_folder(spark, sf_dir, kinds, folder)
        medallion.run(folder)
    entries = files.read_manifest(spark, medallion.manifest)
    return entries.groupBy(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "disposition", "reason").agg(
        F.count(F.lit(1)).cast("int").alias("entries"))


# The rows of the accepted files; quantities are text, as the files have them.
BATCH_SQL = folder_sql(f"""
, typed AS (SELECT 'typed_' || b || '.csv' AS source_file, 't' || k AS order_id, customer_id, product, unit_price,
    list_extract({QUANTITIES}, CAST(k % {len(QUANTITIES)} + 1 AS INTEGER)) AS quantity, '2020-01-01' AS order_date, k
  FROM blocks WHERE copy_no = 2),
accepted AS (
  SELECT source_file, order_id, customer_id, product, unit_price, CAST(quantity AS VARCHAR) AS quantity, order_date,
         discount_code, NULL AS revenue, k FROM orders_rows
  UNION ALL SELECT source_file, order_id, customer_id, product, unit_price, CAST(quantity AS VARCHAR), order_date,
         discount_code, NULL, k FROM promo_rows
  UNION ALL SELECT source_file, order_id, NULL, product, NULL, NULL, order_date, NULL, revenue, k FROM late_rows
  UNION ALL SELECT source_file, order_id, customer_id, product, unit_price, quantity, order_date, NULL, NULL, k FROM typed),
judged AS (SELECT *, CASE WHEN order_id IS NULL OR trim(order_id) = '' THEN 'null_order_id'
       WHEN order_date IS NULL OR trim(order_date) = '' THEN 'null_order_date'
       WHEN try_cast(quantity AS DOUBLE) <= 0 THEN 'non_positive_quantity'
       WHEN unit_price <= 0 THEN 'non_positive_unit_price'
       WHEN try_cast(order_date AS DATE) IS NULL THEN 'invalid_order_date'
       WHEN quantity IS NOT NULL AND coalesce(try_cast(quantity AS DOUBLE) <> floor(try_cast(quantity AS DOUBLE)), TRUE)
       THEN 'invalid_quantity' END AS reason FROM accepted),
kept AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY source_file, k) AS rn
                 FROM judged WHERE reason IS NULL) WHERE rn = 1),
gold AS (
  SELECT CAST(try_cast(order_date AS DATE) AS STRING) AS order_date, count(order_id) AS n,
         sum(coalesce(CAST(revenue AS DOUBLE), 0)) AS revenue FROM kept GROUP BY 1),
result AS (
  SELECT 'bronze' AS layer, source_file, order_id, CAST(customer_id AS VARCHAR) AS customer_id, product, unit_price,
         quantity, order_date, discount_code, round(CAST(revenue AS DOUBLE), 2) AS revenue, NULL AS reason FROM judged
  UNION ALL SELECT 'quarantine', source_file, order_id, CAST(customer_id AS VARCHAR), product, unit_price,
         quantity, order_date, discount_code, round(CAST(revenue AS DOUBLE), 2), reason FROM judged WHERE reason IS NOT NULL
  UNION ALL SELECT 'validated', source_file, order_id, CAST(customer_id AS VARCHAR), product, unit_price,
         CAST(CAST(CAST(quantity AS DOUBLE) AS BIGINT) AS VARCHAR), order_date, discount_code,
         round(CAST(revenue AS DOUBLE), 2), NULL FROM judged WHERE reason IS NULL
  UNION ALL SELECT 'silver', source_file, order_id, CAST(customer_id AS VARCHAR), product, unit_price,
         CAST(CAST(CAST(quantity AS DOUBLE) AS BIGINT) AS VARCHAR), order_date, discount_code,
         round(coalesce(CAST(revenue AS DOUBLE), 0), 2), NULL FROM kept
  UNION ALL SELECT 'gold', NULL, CAST(n AS VARCHAR), NULL, NULL, NULL, NULL, order_date, NULL, round(revenue, 2), NULL FROM gold)
SELECT * FROM result""")


def medallion_tables(medallion):
    """The rows of all five layers under one schema; gold has its order count as the id."""
    result = None
    for layer in ("bronze", "quarantine", "validated", "silver"):
        rows = getattr(medallion, layer).read()
        reason = F.col("rejection_reason") if layer == "quarantine" else F.lit(None).cast("string")
        part = rows.select(
            F.lit(layer).alias("layer"), "source_file", "order_id", F.col("customer_id").cast("string").alias("customer_id"),
            "product", F.col("unit_price").cast("double").alias("unit_price"),
            F.col("quantity").cast("string").alias("quantity"), "order_date", "discount_code",
            F.round(F.col("revenue").cast("double"), 2).alias("revenue"), reason.alias("reason"))
        result = part if result is None else result.unionByName(part)
    nothing = {name: F.lit(None).cast("string") for name in (
        "source_file", "customer_id", "product", "quantity", "discount_code", "reason")}
    gold = medallion.gold.read().select(
        F.lit("gold").alias("layer"), F.col("total_orders_per_day").cast("string").alias("order_id"),
        F.lit(None).cast("double").alias("unit_price"), F.col("order_date").cast("string").alias("order_date"),
        F.round("total_revenue_per_day", 2).alias("revenue")).withColumns(nothing)
    return result.unionByName(gold)


@register("medallion_batch", BATCH_SQL)
def medallion_batch(spark, sf_dir):
    """Good and bad files of every kind in one run; a second run finds nothing to do."""
    folder, root = write_folder(spark, sf_dir, [*ALL_KINDS, "typed"]), work_folder(spark, "medallion")
    medallion = Medallion(spark, root)
    medallion.run(folder)
    medallion.run(folder)
    return medallion_tables(medallion)


_LIVE_COLUMNS = "CAST(customer_id AS VARCHAR) AS customer_id, unit_price, CAST(quantity AS VARCHAR) AS quantity"

_LIVE_ROWS = f"""
, bronze AS (
  SELECT source_file, order_id, product, order_date, {_LIVE_COLUMNS}, discount_code, NULL AS revenue, k, 0 AS copy
  FROM orders_rows
  UNION ALL SELECT source_file, order_id, product, order_date, {_LIVE_COLUMNS}, discount_code, NULL, k, 0 FROM promo_rows
  UNION ALL SELECT source_file, order_id, product, order_date, NULL, NULL, NULL, NULL, revenue, k, 0 FROM late_rows
  UNION ALL SELECT 'repeats_' || b || '.csv', order_id, product, order_date, {_LIVE_COLUMNS}, NULL, NULL, k, range
  FROM blocks, range(3) WHERE copy_no = 1
  UNION ALL SELECT 'nulls_' || b || '.csv', order_id, product, order_date, {_LIVE_COLUMNS}, NULL, NULL, k, 0
  FROM blocks WHERE copy_no = 0 AND (order_id IS NULL OR order_date IS NULL)),
silver3 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_date ORDER BY source_file, k, copy) AS rn FROM bronze)
  WHERE rn = 1),
named AS (SELECT 'bronze' AS layer, * EXCLUDE (k, copy) FROM bronze
          UNION ALL SELECT 'silver', * EXCLUDE (k, copy, rn) FROM silver3)
"""


@register("medallion_live", folder_sql(_LIVE_ROWS + """
SELECT * REPLACE (round(CAST(revenue AS DOUBLE), 2) AS revenue) FROM named"""))
def medallion_live(spark, sf_dir):
    folder = write_folder(spark, sf_dir, ALL_KINDS)
    view = medallion_live_(spark, folder)
    columns = ["source_file", "order_id", "product", "order_date", "customer_id", "unit_price", "quantity", "discount_code",
               F.round(F.col("revenue").cast("double"), 2).alias("revenue")]
    return priced(view.bronze.select(F.lit("bronze").alias("layer"), *columns).unionByName(
        view.silver.select(F.lit("silver").alias("layer"), *columns)))


@register("gold_live", folder_sql("""
, rows_all AS (
  SELECT source_file, order_id, order_date, k FROM orders_rows
  UNION ALL SELECT source_file, order_id, order_date, k FROM promo_rows
  UNION ALL SELECT source_file, order_id, order_date, k FROM late_rows),
latest AS (
  SELECT *, CAST(ts AS DATE) AS d FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, source_file, k) AS rn FROM (
      SELECT *, try_cast(order_date AS TIMESTAMP) AS ts FROM rows_all) WHERE ts IS NOT NULL) WHERE rn = 1)
SELECT CAST(d AS STRING) AS date, count(*) AS total_orders, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_processed
FROM latest GROUP BY d"""))
def gold_live(spark, sf_dir):
    folder = write_folder(spark, sf_dir, ["orders", "promo", "late"])
    gold = gold_live_(spark, folder)
    return gold.select(
        F.col("date").cast("string").alias("date"), "total_orders", "last_processed")


def _inferred_csv(spark, sf_dir):
    """The dirty orders as plain CSV with the names the cleaning jobs expect; some ages are not numbers."""
    folder = work_folder(spark, "csv")
    raw_orders(spark, sf_dir).select(
        F.col("order_id").alias("id"),
        F.when(F.col("k") % 101 == 0, "unknown").otherwise(F.col("customer_id").cast("string")).alias("age"), "product",
        F.round(F.col("unit_price"), 2).alias("revenue"), "order_date"
    ).write.option("header", True).csv(folder)
    return folder


@register("clean_job", raw_sql("""
, rows AS (SELECT DISTINCT CAST(order_id AS BIGINT) AS id,
  CASE WHEN k % 101 = 0 THEN 'unknown' ELSE CAST(customer_id AS VARCHAR) END AS age, product, round(unit_price, 2) AS revenue, order_date FROM raw),
mean AS (SELECT CAST(CAST(round_even(avg(try_cast(age AS DOUBLE)), 0) AS BIGINT) AS VARCHAR) AS m FROM rows)
SELECT id, coalesce(age, m) AS age, product, revenue, order_date, TRUE AS stamped FROM rows, mean"""))
def clean_job_query(spark, sf_dir):
    clean = clean_job(spark, _inferred_csv(spark, sf_dir), work_folder(spark, "cleaned"))
    return clean.select(
        F.col("id").cast("bigint").alias("id"), "age", "product",
        "revenue", "order_date", F.col("processed_time").isNotNull().alias("stamped"))


@register("daily_gold_job", raw_sql("""
, rows AS (SELECT DISTINCT order_id, customer_id, product, unit_price, try_cast(order_date AS DATE) AS d, order_date FROM raw)
SELECT CAST(d AS STRING) AS order_date, count(order_id) AS total_orders_per_day,
       round(sum(round(unit_price, 2)), 2) AS total_revenue_per_day
FROM rows WHERE d IS NOT NULL GROUP BY d"""))
def daily_gold_job(spark, sf_dir):
    gold = daily_gold_job_(spark, _inferred_csv(spark, sf_dir))
    return gold.withColumns({
        "order_date": F.col("order_date").cast("string"),
        "total_revenue_per_day": F.round("total_revenue_per_day", 2)})
