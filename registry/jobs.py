"""Log scan, run log and synthetic data, from the event table."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestrata import constants as const
from lakestrata.operators import audit as a
from lakestrata.session import work_folder
from lakestrata.sources.synthetic import synthetic_orders as synthetic_orders_
from lakestrata.sources.tails import log_tails
from registry import register
from registry.dirty import table
from registry.writing import write_named_files

_WORDS = "|".join(const.LOG_KEYWORDS)


_HIGHLIGHTS = f"""
WITH lines AS (
  SELECT event_type AS source, 'task ' || user_id || ' ' || CASE WHEN event_id % 9 = 0 THEN 'Failed' ELSE 'done' END ||
         ' on ' || props AS line, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS from_end
  FROM events),
recent AS (SELECT * FROM lines WHERE from_end <= 500),
hits AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY from_end) AS n FROM recent
         WHERE regexp_matches(upper(line), '{_WORDS}'))
SELECT source, 'highlight' AS section, from_end, line FROM hits WHERE n <= 15
UNION ALL SELECT source, 'tail', from_end, line FROM recent WHERE from_end <= 40"""


def _write_logs(spark, sf_dir):
    """Event types as task logs: a line per event."""
    state = F.when(F.col("event_id") % 9 == 0, "Failed").otherwise("done")
    place = F.row_number().over(Window.partitionBy("event_type").orderBy("ts", "event_id"))
    lines = table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit(".log")).alias("file_name"), place.cast("bigint").alias("seq"),
        F.concat(F.lit("task "), F.col("user_id"), F.lit(" "), state, F.lit(" on "), F.col("props")).alias("line"))
    folder = work_folder(spark, "logs")
    write_named_files(lines, folder)
    return folder


@register("log_highlights", _HIGHLIGHTS)
def log_highlights(spark, sf_dir):
    """Logs read whole, by file and place."""
    found = a.log_highlights(a.scan_logs(spark, _write_logs(spark, sf_dir)), order_by=["block", "position"])
    return found.withColumn("source", F.regexp_replace("source", r"\.log$", ""))


@register("log_tail_highlights", _HIGHLIGHTS)
def log_tail_highlights(spark, sf_dir):
    """The same of the last lines alone, read from the ends of the files."""
    found = a.log_highlights(log_tails(spark, _write_logs(spark, sf_dir)), order_by=["position"])
    return found.withColumn("source", F.regexp_replace("source", r"\.log$", ""))


@register("run_log", """
SELECT CAST(o_orderpriority AS VARCHAR) AS dag_id, 'SUCCESS' AS status, count(*) AS orders FROM orders GROUP BY 1""")
def run_log(spark, sf_dir):
    """A run per order priority that writes its orders; the log tells how each ended."""
    log, folder = a.RunLog(spark, work_folder(spark, "runs")), work_folder(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    names = [r[0] for r in orders.select("o_orderpriority").distinct().orderBy("o_orderpriority").collect()]
    for name in names:
        with log.task(name, "write"):
            orders.where(F.col("o_orderpriority") == name).select("o_orderpriority", "o_orderkey").write.mode(
                "append").parquet(folder)
    counts = spark.read.parquet(folder).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    latest = a.run_status_latest(log.events(), order_by=["timestamp", "status"])
    return latest.join(counts, F.col("dag_id") == F.col("o_orderpriority")).select("dag_id", "status", "orders")


@register("run_status_latest", """
SELECT user_id AS dag_id, event_type AS status, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def run_status_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("dag_id"), F.col("event_type").alias("status"), "ts", "event_id")
    return a.run_status_latest(events, order_by=["ts", "event_id"]).drop("ts")


@register("run_durations", """
SELECT user_id AS run_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS finished,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(1000000 AS DOUBLE), 3) AS duration_seconds,
       count(DISTINCT event_type) AS task_count
FROM events GROUP BY user_id""")
def run_durations(spark, sf_dir):
    runs = a.run_durations(table(spark, sf_dir, "events"), "user_id", "event_type", "ts")
    return runs.select(
        F.col("user_id").alias("run_id"), F.date_format("started", const.TIMESTAMP_FORMAT).alias("started"),
        F.date_format("finished", const.TIMESTAMP_FORMAT).alias("finished"),
        F.round("duration_seconds", 3).alias("duration_seconds"), "task_count")


def _digest(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 12) AS BIGINT)"


_PRODUCTS = ", ".join(f"'{name}'" for name in const.SYNTHETIC_PRODUCTS)


@register("synthetic_orders", f"""
WITH picked AS (SELECT o_orderkey AS draw, {_digest("'0|' || o_orderkey")} % 200 AS base FROM orders)
SELECT draw, 'J' || (base + 1000) AS order_id, '2024-03-14' AS order_date,
       list_extract([{_PRODUCTS}], CAST({_digest("'0p|' || base")} % 5 AS INTEGER) + 1) AS product,
       (5000 + {_digest("'0r|' || base")} % 45001) / CAST(100 AS DOUBLE) AS revenue
FROM picked""")
def synthetic_orders(spark, sf_dir):
    """One draw per order."""
    return synthetic_orders_(table(spark, sf_dir, "orders"), key="o_orderkey")
