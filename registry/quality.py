"""Quality checks, roll-up, report and profile."""

from pyspark.sql import functions as F

from lakestrata import constants as const
from lakestrata.operators import quality as q
from lakestrata.operators import rules as r
from lakestrata.plans.report import check_layers
from lakestrata.session import work_folder
from lakestrata.sources import sinks
from registry import register
from registry.dirty import AS_OF, ORDER, Layers, layers_sql, raw_orders, raw_sql
from registry.writing import write_named_files

DATA = ["order_id", "customer_id", "product", "unit_price", "quantity", "order_date"]


@register("row_count", raw_sql("SELECT count(*) AS rows FROM raw"))
def row_count(spark, sf_dir):
    return q.row_count(raw_orders(spark, sf_dir))


@register("quality_ratios", raw_sql(f"""
, distinct_rows AS (SELECT DISTINCT {', '.join(DATA)} FROM raw)
SELECT count(*) AS total_rows,
       round((count(*) - (SELECT count(*) FROM distinct_rows)) / CAST(count(*) AS DOUBLE), 8) AS dup_ratio,
       round(count(CASE WHEN order_id IS NULL OR order_date IS NULL THEN 1 END) / CAST(count(*) AS DOUBLE), 8) AS null_ratio
FROM raw"""))
def quality_ratios(spark, sf_dir):
    ratios = r.quality_ratios(raw_orders(spark, sf_dir).select(*DATA))
    return ratios.withColumns({
        "dup_ratio": F.round("dup_ratio", 8), "null_ratio": F.round("null_ratio", 8)})


@register("null_profile", raw_sql("""
SELECT 'order_id' AS "column", count(*) - count(order_id) AS nulls,
       CAST(format('{:.2f}', (count(*) - count(order_id)) * CAST(100 AS DOUBLE) / count(*)) AS DOUBLE) AS pct FROM raw
UNION ALL SELECT 'order_date', count(*) - count(order_date),
       CAST(format('{:.2f}', (count(*) - count(order_date)) * CAST(100 AS DOUBLE) / count(*)) AS DOUBLE) FROM raw
UNION ALL SELECT 'customer_id', count(*) - count(customer_id),
       CAST(format('{:.2f}', (count(*) - count(customer_id)) * CAST(100 AS DOUBLE) / count(*)) AS DOUBLE) FROM raw"""))
def null_profile(spark, sf_dir):
    return q.null_profile(raw_orders(spark, sf_dir), const.BATCH_NULL_COLUMNS)


# The batch checks of the five layers, stated over the derived layer tables.
def _batch_layer(layer: str) -> str:
    """Check rows of one layer that has the order columns."""
    unique = layer == "silver"
    severity, note = ("CRITICAL", "unexpected at this layer") if unique else ("WARNING", "expected in Bronze")

    def nulls(column, number):
        return f"""
  SELECT {number}, 'null_check_{column}',
    CASE WHEN nn = 0 THEN 'PASS' WHEN pct > 5 THEN 'CRITICAL' ELSE 'WARNING' END,
    CASE WHEN nn = 0 THEN 'No nulls in {column}'
         WHEN pct > 5 THEN nn || ' nulls in {column} (' || CAST(pct AS VARCHAR) || '%) — exceeds 5% threshold'
         ELSE nn || ' nulls in {column} (' || CAST(pct AS VARCHAR) || '%)' END
  FROM (SELECT count(*) - count({column}) AS nn,
               CAST(format('{{:.2f}}', (count(*) - count({column})) * CAST(100 AS DOUBLE) / count(*)) AS DOUBLE) AS pct FROM {layer})"""

    def counted(number, name, condition, bad, good, message):
        return f"""
  SELECT {number}, '{name}', CASE WHEN c > 0 THEN '{bad}' ELSE 'PASS' END,
    CASE WHEN c = 0 THEN '{good}' ELSE c || '{message}' END
  FROM (SELECT count(CASE WHEN {condition} THEN 1 END) AS c FROM {layer})"""

    parts = [f"""
  SELECT 1 AS check_no, 'row_count' AS name, CASE WHEN count(*) = 0 THEN 'CRITICAL' ELSE 'PASS' END AS status,
    CASE WHEN count(*) = 0 THEN 'Table is empty (0 rows)' ELSE format('{{:,}}', count(*)) || ' rows' END AS message
  FROM {layer}""",
        nulls("order_id", 2), nulls("order_date", 3), nulls("customer_id", 4), f"""
  SELECT 5, 'duplicate_order_ids', CASE WHEN s = 0 THEN 'PASS' ELSE '{severity}' END,
    CASE WHEN s = 0 THEN 'No duplicate order_ids'
         ELSE s || ' duplicate order_id(s) (' || CAST(pct AS VARCHAR) || '%) — {note}' END
  FROM (SELECT CAST(sum(n) - count(*) AS BIGINT) AS s,
               CAST(format('{{:.2f}}', (sum(n) - count(*)) * CAST(100 AS DOUBLE) / sum(n)) AS DOUBLE) AS pct
        FROM (SELECT order_id, count(*) AS n FROM {layer} GROUP BY order_id))""",
        counted(6, "range_unit_price", "unit_price <= 0", "WARNING", "All unit_price values > 0",
                " row(s) with unit_price <= 0"),
        counted(7, "range_quantity", "quantity <= 0", "WARNING", "All quantity values > 0",
                " row(s) with quantity <= 0"),
        counted(8, "date_validity", "try_cast(order_date AS DATE) IS NULL", "CRITICAL",
                "All order_date values parse as valid dates", " row(s) with unparseable order_date"),
        counted(9, "future_dates", f"try_cast(order_date AS DATE) > DATE '{AS_OF}'", "WARNING",
                "No future-dated records", " row(s) with future order_date"),
        "\n  SELECT 10, 'schema_check', 'PASS', 'All required columns present'"]
    if layer == "quarantine":
        parts.append(counted(11, "rejection_reason_completeness",
                             "rejection_reason IS NULL OR rejection_reason = ''", "CRITICAL",
                             "All quarantined records have rejection reasons",
                             " quarantine records missing rejection reason"))
    if layer == "silver":
        parts.append(f"""
  SELECT 11, 'silver_row_sanity', 'PASS',
    'Silver has ' || format('{{:,}}', count(*)) || ' rows (duplicates removed from validated)' FROM silver""")
    label = "bronze" if layer == "raw" else layer
    return f"""SELECT '{label}' AS layer, x.*, (SELECT count(*) FROM {layer}) AS row_count FROM (
{' UNION ALL '.join(parts)}) AS x"""


_GOLD_LAYER = f"""SELECT 'gold' AS layer, x.*, (SELECT count(*) FROM gold) AS row_count FROM (
  SELECT 1 AS check_no, 'row_count' AS name, 'PASS' AS status, format('{{:,}}', count(*)) || ' rows' AS message FROM gold
  UNION ALL SELECT 2, 'null_check_order_date', 'PASS', 'No nulls in order_date'
  UNION ALL SELECT 3, 'date_validity', 'PASS', 'All order_date values parse as valid dates'
  UNION ALL SELECT 4, 'future_dates', CASE WHEN c > 0 THEN 'WARNING' ELSE 'PASS' END,
    CASE WHEN c = 0 THEN 'No future-dated records' ELSE c || ' row(s) with future order_date' END
  FROM (SELECT count(CASE WHEN try_cast(order_date AS DATE) > DATE '{AS_OF}' THEN 1 END) AS c FROM gold)
  UNION ALL SELECT 5, 'schema_check', 'PASS', 'All required columns present') AS x"""

CHECKS_SQL = layers_sql(", checks AS (\n" + "\nUNION ALL ".join(
    [*map(_batch_layer, ["raw", "quarantine", "validated", "silver"]), _GOLD_LAYER]) + ")\n")


def _all_checks(spark, sf_dir):
    result = None
    for layer, df in Layers(spark, sf_dir).tables.items():
        part = q.batch_checks(df, layer, AS_OF)
        result = part if result is None else result.unionByName(part)
    return result


@register("dq_batch_checks", CHECKS_SQL + "SELECT * FROM checks")
def dq_batch_checks(spark, sf_dir):
    return _all_checks(spark, sf_dir)


ROLLUP_SQL = CHECKS_SQL.rstrip() + """,
layers AS (
  SELECT layer, max(row_count) AS row_count, count(*) AS checks_run,
         count(CASE WHEN status = 'PASS' THEN 1 END) AS passing,
         count(CASE WHEN status = 'CRITICAL' THEN 1 END) AS critical_failures,
         count(CASE WHEN status = 'WARNING' THEN 1 END) AS warnings
  FROM checks GROUP BY layer),
rolled AS (
  SELECT *, CASE WHEN critical_failures > 0 THEN 'FAIL' WHEN warnings > 0 THEN 'WARN' ELSE 'PASS' END AS status
  FROM layers)
"""


@register("quality_rollup", ROLLUP_SQL + "SELECT * FROM rolled")
def quality_rollup(spark, sf_dir):
    return q.rollup(_all_checks(spark, sf_dir))


@register("quality_totals", ROLLUP_SQL + """
SELECT CAST(sum(row_count) AS BIGINT) AS rows_checked, CAST(sum(checks_run) AS BIGINT) AS checks_run,
       CAST(sum(passing) AS BIGINT) AS passing, CAST(sum(critical_failures) AS BIGINT) AS critical_failures,
       CAST(sum(warnings) AS BIGINT) AS warnings, CAST(sum(critical_failures + warnings) AS BIGINT) AS issues,
       CASE WHEN sum(critical_failures) > 0 THEN 'FAIL' WHEN sum(warnings) > 0 THEN 'WARN' ELSE 'PASS' END AS overall_status
FROM rolled""")
def quality_totals(spark, sf_dir):
    return q.report_totals(q.rollup(_all_checks(spark, sf_dir)))


@register("quality_report", ROLLUP_SQL + """
SELECT 'FAIL' AS overall_status, c.layer, r.status AS layer_status, r.row_count, r.critical_failures, r.warnings,
       c.name, c.status, c.message
FROM checks AS c JOIN rolled AS r ON c.layer = r.layer
UNION ALL SELECT 'FAIL', 'missing', 'FAIL', 0, 1, 0, 'path_exists', 'CRITICAL', 'found missing'""")
def quality_report(spark, sf_dir):
    """Layers written as tables, examined (one of them is missing), reported as JSON, read back."""
    root = work_folder(spark, "layers")
    for layer, df in Layers(spark, sf_dir).tables.items():
        sinks.write_parquet(df, f"{root}/{layer}")
    paths = {layer: f"{root}/{layer}" for layer in [*const.LAYERS, "missing"]}
    report = q.quality_report(check_layers(spark, paths, AS_OF))
    sinks.write_report(report, f"{root}/report")
    read = spark.read.schema(report.schema).json(f"{root}/report")
    layers = read.select("overall_status", F.inline("layers")).withColumnRenamed("status", "layer_status")
    rows = layers.select(
        "overall_status", "layer", "layer_status", "row_count", "critical_failures", "warnings", F.inline("checks"))
    gone = F.col("name") == "path_exists"
    return rows.withColumn("message", F.when(gone, "found missing").otherwise(F.col("message")))


@register("dq_failing_layers", layers_sql("""
, ids AS (SELECT order_id, count(*) AS n FROM raw GROUP BY order_id),
surplus AS (SELECT CAST(sum(n) - count(*) AS BIGINT) AS s,
  CAST(format('{:.2f}', (sum(n) - count(*)) * CAST(100 AS DOUBLE) / sum(n)) AS DOUBLE) AS pct FROM ids)
SELECT 'silver' AS layer, 'duplicate_order_ids' AS name, 'CRITICAL' AS status,
       s || ' duplicate order_id(s) (' || CAST(pct AS VARCHAR) || '%) — unexpected at this layer' AS message FROM surplus
UNION ALL SELECT 'bronze', 'schema_check', 'CRITICAL', 'Missing required columns: [''source_file'']'
UNION ALL SELECT 'quarantine', 'rejection_reason_completeness', 'CRITICAL',
  count(*) || ' quarantine records missing rejection reason' FROM quarantine WHERE k % 2 = 0
UNION ALL SELECT 'validated', 'clean_validation', 'CRITICAL',
  count(*) || ' validated records still have rejection reasons' FROM validated WHERE k % 3 = 0
UNION ALL SELECT 'gold', 'delta_read', 'CRITICAL', 'unreadable'
UNION ALL SELECT 'lost', 'path_exists', 'CRITICAL', 'missing'"""))
def dq_failing_layers(spark, sf_dir):
    """Each check that only fails on a broken table, on one: copies in silver, a lost column, reasons that are
    missing or should not be there, a table that cannot be read and one that is not there."""
    root, tables = work_folder(spark, "layers"), Layers(spark, sf_dir).tables
    reason = F.col("rejection_reason")
    broken = {
        "silver": tables["bronze"].withColumn("processing_timestamp", F.current_timestamp()),
        "bronze": tables["bronze"].drop("source_file"),
        "quarantine": tables["quarantine"].withColumn("rejection_reason", F.when(F.col("k") % 2 == 1, reason)),
        "validated": tables["validated"].withColumn("rejection_reason", F.when(F.col("k") % 3 == 0, "old")),
    }
    for layer, df in broken.items():
        sinks.write_parquet(df, f"{root}/{layer}")
    write_named_files(spark.createDataFrame(
        [("part-0.parquet", 0, "no parquet")], "file_name string, seq int, line string"), f"{root}/gold")
    examined = check_layers(spark, {layer: f"{root}/{layer}" for layer in [*broken, "gold", "lost"]}, AS_OF)
    checks = examined[0].checks
    for layer in examined[1:]:
        checks = checks.unionByName(layer.checks)
    wanted = {
        "silver": "duplicate_order_ids", "bronze": "schema_check", "quarantine": "rejection_reason_completeness",
        "validated": "clean_validation", "gold": "delta_read", "lost": "path_exists"}
    picked = F.lit(False)
    for layer, name in wanted.items():
        picked = picked | ((F.col("layer") == layer) & (F.col("name") == name))
    shown = F.when(F.col("name") == "delta_read", "unreadable").when(
        F.col("name") == "path_exists", "missing").otherwise(F.col("message"))
    return checks.where(picked).select("layer", "name", "status", shown.alias("message"))


def _live_layer(layer: str, label: str) -> str:
    dedup = "" if label != "silver" else """
  UNION ALL SELECT 8, 'Deduplication Applied', 'PASS',
    (b - s) || ' duplicate row(s) removed (' || format('{:.1f}', (b - s) * CAST(100 AS DOUBLE) / b) || '% of Bronze). ' ||
    format('{:,}', s) || ' unique records remain.'
  FROM (SELECT (SELECT count(*) FROM tabbed) AS b, (SELECT count(*) FROM silver3) AS s)"""
    return f"""SELECT '{label}' AS layer, x.*, (SELECT count(*) FROM {layer}) AS row_count FROM (
  SELECT 1 AS check_no, 'Row Count' AS name, 'PASS' AS status, format('{{:,}}', count(*)) || ' rows found.' AS message FROM {layer}
  UNION ALL SELECT 2, 'Required Columns Present', 'PASS', 'All required columns found.'
  UNION ALL SELECT 3, 'No Duplicate Order IDs', 'WARNING', sum(n) || ' duplicate rows for IDs: ' ||
    (SELECT string_agg(coalesce(order_id, 'None'), ', ' ORDER BY pos) FROM
       (SELECT order_id, min(copy_no * 1000000000000 + k) AS pos FROM {layer} GROUP BY order_id HAVING count(*) > 1
        ORDER BY pos LIMIT 5)) ||
    CASE WHEN count(*) > 5 THEN ' … and ' || (count(*) - 5) || ' more' ELSE '' END
  FROM (SELECT order_id, count(*) AS n FROM {layer} GROUP BY order_id HAVING count(*) > 1)
  UNION ALL SELECT 4, 'No Null Critical Fields', 'CRITICAL',
    'order_id: ' || count(CASE WHEN order_id IS NULL OR order_id = chr(9) THEN 1 END) || ' null/empty | order_date: ' || (count(*) - count(order_date)) || ' null/empty'
  FROM {layer}
  UNION ALL SELECT 5, 'No Negative Numeric Values', 'WARNING',
    'unit_price: ' || count(CASE WHEN unit_price < 0 THEN 1 END) || ' negative value(s)' FROM {layer}
  UNION ALL SELECT 6, 'Valid Date Format', 'WARNING',
    count(CASE WHEN try_cast(order_date AS TIMESTAMP) IS NULL THEN 1 END) || ' row(s) have unparsable dates.' FROM {layer}
  UNION ALL SELECT 7, 'No Future Dates', 'WARNING',
    count(CASE WHEN try_cast(order_date AS TIMESTAMP) > TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY THEN 1 END) ||
    ' row(s) have dates set in the future.' FROM {layer}{dedup}) AS x"""


@register("dq_live_checks", raw_sql(f"""
, tabbed AS (SELECT * REPLACE (CASE WHEN k % 71 = 0 THEN chr(9) ELSE order_id END AS order_id) FROM raw),
silver3 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_date ORDER BY copy_no, k) AS rn FROM tabbed)
  WHERE rn = 1),
issues AS (SELECT DISTINCT k // 2000 AS f FROM raw),
checks AS (
SELECT 'input' AS layer, x.*, (SELECT 2 * count(*) FROM issues) AS row_count FROM (
  SELECT 1 AS check_no, 'File Formats' AS name, 'WARNING' AS status,
         count(*) || ' file(s) follow unsupported formats.' AS message FROM issues
  UNION ALL SELECT 2, 'Data Integrity', 'CRITICAL', count(*) || ' corrupted file(s) found in input folder.' FROM issues) AS x
UNION ALL {_live_layer("tabbed", "bronze")}
UNION ALL {_live_layer("silver3", "silver")})
SELECT * FROM checks"""))
def dq_live_checks(spark, sf_dir):
    from lakestrata.operators.dedup import dedup_composite
    """Orders with ids of a tab alone among them, and for each block an unsupported and a corrupted file."""
    raw = raw_orders(spark, sf_dir).withColumn(
        "order_id", F.when(F.col("k") % 71 == 0, "\t").otherwise(F.col("order_id")))
    reasons = F.array(
        F.format_string(const.ISSUE_UNSUPPORTED[1], F.lit(".txt")), F.format_string(const.ISSUE_BAD_CSV[1], F.lit("x")))
    issues = raw.select(F.floor(F.col("k") / 2000).alias("f")).distinct().select(F.explode(reasons).alias("Reason"))
    silver = dedup_composite(raw, order_by=ORDER)
    return q.live_checks(issues, raw, silver, ORDER, AS_OF)


@register("column_profile", raw_sql("SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT {i} AS position, '{name}' AS \"column\", count(*) AS rows, count(*) - count({name}) AS nulls, "
    f"count(DISTINCT {name}) AS distinct_values, "
    f"CAST(format('{{:.2f}}', (count(*) - count({name})) * CAST(100 AS DOUBLE) / count(*)) AS DOUBLE) AS null_pct, "
    f"CAST(format('{{:.2f}}', count(DISTINCT {name}) * CAST(100 AS DOUBLE) / count(*)) AS DOUBLE) AS unique_pct FROM raw"
    for i, name in enumerate(DATA)) + ")"))
def column_profile(spark, sf_dir):
    return q.column_profile(raw_orders(spark, sf_dir), DATA)
