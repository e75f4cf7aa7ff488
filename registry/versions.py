"""Versioned tables: the dirty orders arriving copy by copy as versions."""

from pyspark.sql import functions as F

from lakestrata.operators import asof
from lakestrata.operators import quality as q
from lakestrata.operators.audit import record_inspection as record_inspection_
from lakestrata.operators.rules import split_quarantine
from lakestrata.session import work_folder
from lakestrata.sources import versioned as v
from lakestrata.sources.profiles import Profiles
from registry import register
from registry.dirty import AS_OF, ORDER, layers_sql, raw_orders, raw_sql


def _appended(spark, sf_dir):
    """Copies 0, 1 and 2 appended as versions 0, 1 and 2."""
    table = v.VersionedTable(spark, work_folder(spark, "versions"))
    raw = raw_orders(spark, sf_dir)
    for copy in range(3):
        table.append(raw.where(F.col("copy_no") == copy))
    return table


def _overwritten(spark, sf_dir):
    """Version n holds all copies up to n."""
    table = v.VersionedTable(spark, work_folder(spark, "versions"))
    raw = raw_orders(spark, sf_dir)
    for copy in range(3):
        table.overwrite(raw.where(F.col("copy_no") <= copy))
    return table


@register("sink_append", raw_sql("SELECT * FROM raw"))
def sink_append(spark, sf_dir):
    table = _appended(spark, sf_dir)
    # A transaction that is already committed adds nothing.
    last = raw_orders(spark, sf_dir).where("copy_no = 2")
    table.append(last.limit(0), txn="again")
    table.append(last, txn="again")
    return table.read()


@register("sink_overwrite_version", raw_sql("""
SELECT 0 AS version, count(*) AS rows FROM raw WHERE copy_no <= 0 UNION ALL SELECT 1, count(*) FROM raw WHERE copy_no <= 1
UNION ALL SELECT 2, count(*) FROM raw"""))
def sink_overwrite_version(spark, sf_dir):
    table = _overwritten(spark, sf_dir)
    counts = [table.read(n).agg(F.lit(n).alias("version"), F.count(F.lit(1)).alias("rows")) for n in range(3)]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@register("versioned_latest", raw_sql("SELECT * FROM raw"))
def versioned_latest(spark, sf_dir):
    return _overwritten(spark, sf_dir).read()


@register("version_as_of", raw_sql("SELECT * FROM raw WHERE copy_no <= 1"))
def version_as_of(spark, sf_dir):
    return _appended(spark, sf_dir).read(1)


@register("commit_history", raw_sql("""
, n AS (SELECT copy_no, count(*) AS c FROM raw GROUP BY copy_no)
SELECT CAST(v AS VARCHAR) AS version, 'WRITE' AS operation, '{"mode":"Append"}' AS "operationParameters", TRUE AS "isBlindAppend",
       TRUE AS timed, (SELECT CAST(sum(c) AS BIGINT) FROM n WHERE copy_no <= v) AS total_rows,
       (SELECT c FROM n WHERE copy_no = v) AS num_rows, TRUE AS has_files, TRUE AS has_bytes FROM range(3) AS r(v)
UNION ALL SELECT 'Pending', 'INGESTION', 'Scanning raw CSVs', TRUE, FALSE, NULL, NULL, NULL, NULL"""))
def commit_history(spark, sf_dir):
    table = _appended(spark, sf_dir)
    rows = table.commits().select(
        F.col("version").cast("string").alias("version"), "total_rows", "num_rows",
        (F.col("num_files") > 0).alias("has_files"), (F.col("num_bytes") > 0).alias("has_bytes"))
    shown = v.with_pending(table.history())
    return shown.join(rows, "version", "left").select(
        "version", "operation", "operationParameters", "isBlindAppend",
        F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$").alias("timed"), "total_rows", "num_rows",
        "has_files", "has_bytes")


@register("restore_version", raw_sql("""
SELECT order_id, k, copy_no FROM raw WHERE copy_no <= 1
UNION ALL SELECT order_id, k, copy_no FROM raw WHERE copy_no = 2"""))
def restore_version(spark, sf_dir):
    """Back to version 1 without copying, then a further append on top of it."""
    table = _appended(spark, sf_dir)
    table.overwrite(raw_orders(spark, sf_dir).where("copy_no = 1"))
    table.restore(1)
    table.append(raw_orders(spark, sf_dir).where("copy_no = 2"))
    return table.read().select("order_id", "k", "copy_no")


@register("version_diff", raw_sql("""
SELECT 'added' AS change, * FROM raw WHERE copy_no = 2
UNION ALL SELECT 'removed', * FROM raw WHERE copy_no = 0"""))
def version_diff(spark, sf_dir):
    """Two versions that share some rows: only what differs, without reading what is the same folder."""
    table = v.VersionedTable(spark, work_folder(spark, "versions"))
    raw = raw_orders(spark, sf_dir)
    table.overwrite(raw.where("copy_no <= 1"))
    table.overwrite(raw.where("copy_no >= 1"))
    return table.diff(0, 1)


def _day_commits(rows):
    """One commit per day, its time in the middle of the day, versions in day order."""
    days = rows.where(F.col("order_date").try_cast("date").isNotNull()).groupBy("order_date").agg(
        F.count(F.lit(1)).alias("total_rows"))
    day = F.unix_date(F.col("order_date").cast("date")).cast("bigint")
    return days.select(
        day.alias("version"), (day * 86_400_000 + F.pmod(day, F.lit(7)) * 60_000).alias("timestamp"), "total_rows")


_DAY_COMMITS = """
, accepted AS (
  SELECT datediff('day', DATE '1970-01-01', CAST(order_date AS DATE)) AS version, count(*) AS num_rows FROM validated GROUP BY 1),
rejected AS (
  SELECT datediff('day', DATE '1970-01-01', try_cast(order_date AS DATE)) AS version, count(*) AS num_rows
  FROM quarantine WHERE try_cast(order_date AS DATE) IS NOT NULL GROUP BY 1),
a AS (SELECT version, version * 86400000 + (version % 7) * 60000 AS ts, num_rows FROM accepted),
q AS (SELECT version, version * 86400000 + (version % 7) * 60000 + 200000 AS ts, num_rows FROM rejected),
pairs AS (
  SELECT a.version, a.ts AS "timestamp", a.num_rows AS clean_rows,
         max(q.version) AS rejected_version, arg_max(q.num_rows, q.version) AS rejected_rows
  FROM a LEFT JOIN q ON q.ts <= a.ts + 180000 GROUP BY ALL)
"""


def _asof_pairs(spark, sf_dir):
    validated, quarantine = split_quarantine(raw_orders(spark, sf_dir))
    rejected = _day_commits(quarantine).withColumn("timestamp", F.col("timestamp") + 200000)
    return _day_commits(validated), rejected


@register("version_asof_join", layers_sql(_DAY_COMMITS + """
SELECT version, "timestamp", clean_rows, rejected_version, coalesce(rejected_rows, 0) AS rejected_rows FROM pairs"""))
def version_asof_join(spark, sf_dir):
    """Every day's accepted rows against the newest rejected rows within the tolerance."""
    return asof.accepted_vs_rejected(*_asof_pairs(spark, sf_dir))


@register("version_trend", layers_sql(_DAY_COMMITS + """
SELECT 'v' || version AS version, strftime(make_timestamp("timestamp" * 1000), '%H:%M:%S') AS time, clean_rows AS clean,
       coalesce(rejected_rows, 0) AS rejected, version AS version_no
FROM pairs ORDER BY version_no DESC LIMIT 5"""))
def version_trend(spark, sf_dir):
    return v.version_trend(*_asof_pairs(spark, sf_dir))


@register("rca_trend", layers_sql("""
, versions AS (SELECT v FROM range(3) AS r(v)),
counts AS (
  SELECT v, (SELECT count(*) FROM validated WHERE copy_no <= v) AS clean_rows,
         (SELECT count(*) FROM quarantine WHERE copy_no <= v) AS rejected_rows,
         (SELECT count(*) - count(DISTINCT order_id) FROM validated WHERE copy_no <= v) AS surplus,
         (SELECT count(*) - count(customer_id) FROM validated WHERE copy_no <= v) AS no_customer,
         (SELECT count(*) FROM validated WHERE copy_no <= v AND try_cast(order_date AS DATE) > DATE '2026-03-14') AS future
  FROM versions)
SELECT v AS version, clean_rows, rejected_rows,
       round(rejected_rows / CAST(clean_rows + rejected_rows AS DOUBLE), 8) AS rejection_ratio,
       round((9 - (surplus > 0)::INT - (no_customer > 0)::INT - (future > 0)::INT) / CAST(9 AS DOUBLE), 8) AS dq_score
FROM counts"""))
def rca_trend(spark, sf_dir):
    """Accepted and rejected rows and the share of checks passed, for every version."""
    accepted = v.VersionedTable(spark, work_folder(spark, "silver"))
    rejected = v.VersionedTable(spark, work_folder(spark, "quarantine"))
    scores = None
    for copy in range(3):
        clean, bad = split_quarantine(raw_orders(spark, sf_dir).where(F.col("copy_no") <= copy))
        rejected.overwrite(bad)
        number = accepted.overwrite(clean)
        checks = q.batch_checks(accepted.read(number), "other", AS_OF).where(F.col("name") != "schema_check")
        score = q.rollup(checks).select(F.lit(number).cast("bigint").alias("version"), "passing", "checks_run")
        scores = score if scores is None else scores.unionByName(score)
    # Rejected rows are committed just before the accepted ones; no grace is needed to pair them.
    trend = asof.accepted_vs_rejected(accepted.commits(), rejected.commits(), tolerance_ms=0)
    return v.rca_view(trend, scores).withColumns({
        "rejection_ratio": F.round("rejection_ratio", 8), "dq_score": F.round("dq_score", 8)})


@register("record_inspection", layers_sql("""
SELECT * FROM (SELECT 'valid' AS record_state, order_id, product, order_date, k, copy_no, NULL AS rejection_reason
               FROM validated ORDER BY copy_no, k LIMIT 50)
UNION ALL
SELECT * FROM (SELECT 'rejected', order_id, product, order_date, k, copy_no, rejection_reason
               FROM quarantine ORDER BY copy_no, k LIMIT 50)"""))
def record_inspection(spark, sf_dir):
    valid, rejected = split_quarantine(raw_orders(spark, sf_dir))
    return record_inspection_(valid, rejected, ORDER).select(
        "record_state", "order_id", "product", "order_date", "k", "copy_no", "rejection_reason")


_PROFILED = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]


def _profile_sql(version: int, where: str, name: str) -> str:
    low, high = (f"CAST({end}({name}) AS DOUBLE)" if name != "o_orderpriority" else "CAST(NULL AS DOUBLE)" for end in ("min", "max"))
    return (f"SELECT {version} AS version, '{name}' AS \"column\", count(*) AS rows, count(*) - count({name}) AS nulls, "
            f"{low} AS low, {high} AS high, count(DISTINCT {name}) AS distinct_values, TRUE AS within FROM profiled WHERE {where}")


@register("version_profile", """WITH profiled AS (
SELECT o_orderkey, CASE WHEN o_orderkey % 37 <> 0 THEN o_custkey END AS o_custkey, o_totalprice, o_orderpriority FROM orders)
""" + "\nUNION ALL ".join(
    _profile_sql(version, where, name) for version, where in enumerate(["o_orderkey % 3 = 0", "o_orderkey % 3 < 2", "o_orderkey % 3 = 2"])
    for name in _PROFILED))
def version_profile(spark, sf_dir):
    """Profiles of three versions from sketches; ``within`` tells whether the exact number of values is inside the bounds."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 37 != 0, F.col("o_custkey")).alias("o_custkey"), "o_totalprice", "o_orderpriority")
    versioned = v.VersionedTable(spark, work_folder(spark, "profiled"))
    k = F.col("o_orderkey") % 3
    versioned.append(orders.where(k == 0))
    versioned.append(orders.where(k == 1))
    versioned.overwrite(orders.where(k == 2))
    profiles = Profiles(versioned)
    found = []
    for version in range(3):
        exact = q.column_profile(versioned.read(version)).select("column", "distinct_values")
        found.append(profiles.profile(version).withColumnRenamed("distinct_values", "estimate").join(exact, "column").select(
            F.lit(version).alias("version"), "column", "rows", "nulls", "low", "high", "distinct_values",
            F.col("distinct_values").between(F.col("distinct_from"), F.col("distinct_to")).alias("within")))
    return found[0].unionByName(found[1]).unionByName(found[2])
