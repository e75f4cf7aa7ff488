"""File streams drained to the end, run twice."""

from pyspark.sql import functions as F

from lakestrata.plans.batch import Medallion
from lakestrata.session import work_folder
from lakestrata.streaming.ingest import BronzeTables, ingest_stream, medallion_stream
from lakestrata.streaming.latest import LatestRows
from registry import register
from registry.dirty import raw_orders, raw_sql
from registry.filelayer import ALL_KINDS, BATCH_SQL, medallion_tables, priced
from registry.folder import folder_sql, write_folder


@register("stream_bronze_ingest", folder_sql("""
, all_rows AS (SELECT * FROM orders_rows UNION ALL SELECT * FROM promo_rows)
SELECT order_id, CAST(customer_id AS VARCHAR) AS customer_id, product, unit_price, CAST(quantity AS VARCHAR) AS quantity,
       order_date, discount_code, source_file, TRUE AS stamped, NULL AS issue FROM all_rows
UNION ALL SELECT DISTINCT 'CRITICAL', NULL, 'N/A', NULL, NULL, 'N/A', NULL, 'broken_' || b || '.json', FALSE,
  'Corrupted JSON: File could not be parsed. Error: malformed record' FROM blocks WHERE copy_no = 2
UNION ALL SELECT DISTINCT 'EMPTY', NULL, 'N/A', NULL, NULL, 'N/A', NULL, 'empty_' || b || '.csv', FALSE,
  'Corrupted Data: File is empty or has no rows.' FROM blocks"""))
def stream_bronze_ingest(spark, sf_dir):
    """A first layout, then one with a further column, broken and empty files: rows and issues."""
    folder = write_folder(spark, sf_dir, ["orders", "empty"])
    root, checkpoint = work_folder(spark, "bronze"), work_folder(spark, "stream")
    for _ in range(2):
        ingest_stream(spark, folder, root, checkpoint).awaitTermination()
    write_folder(spark, sf_dir, ["promo", "broken"], folder)
    for _ in range(2):
        ingest_stream(spark, folder, root, checkpoint).awaitTermination()
    tables = BronzeTables(spark, root)
    rows, issues = tables.bronze.read(), tables.issues.read().withColumnRenamed("Reason", "issue")
    return priced(rows.withColumn("stamped", F.col("ingestion_timestamp").isNotNull()).drop("ingestion_timestamp").unionByName(
        issues.withColumn("stamped", F.lit(False)), allowMissingColumns=True))


@register("stream_medallion", BATCH_SQL)
def stream_medallion(spark, sf_dir):
    """Two streams with checkpoints of their own fill one medallion; the first loses its state on the way."""
    root = work_folder(spark, "medallion")
    one = write_folder(spark, sf_dir, ALL_KINDS[:5])
    two = write_folder(spark, sf_dir, [*ALL_KINDS[5:], "typed"])
    for folder, checkpoint in ((one, "a"), (two, "b"), (one, "c"), (two, "b")):
        medallion_stream(spark, folder, root, f"{root}-{checkpoint}").awaitTermination()
    return medallion_tables(Medallion(spark, root))


@register("latest_wins_stream", raw_sql("""
, dated AS (SELECT *, try_cast(order_date AS TIMESTAMP) AS ts FROM raw
            WHERE order_id IS NOT NULL AND order_date < '2900' AND try_cast(order_date AS TIMESTAMP) IS NOT NULL)
SELECT order_id, product, quantity, k, copy_no, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts DESC, copy_no DESC, k DESC) AS rn FROM dated) WHERE rn = 1"""))
def latest_wins_stream(spark, sf_dir):
    """The dirty orders arrive in three deliveries, copies and corrections last; the stream is started anew for each."""
    place, root = work_folder(spark, "events"), work_folder(spark, "latest")
    events = raw_orders(spark, sf_dir).where("order_id IS NOT NULL AND order_date < '2900'").select(
        "order_id", "product", "quantity", "k", "copy_no", F.try_to_timestamp("order_date").alias("moment"))
    schema = "order_id string, product string, quantity bigint, k bigint, copy_no int, moment timestamp"
    latest = LatestRows(spark, root, "order_id", "moment", ["copy_no", "k"])
    for copy_no in (0, 1, 2):
        events.where(F.col("copy_no") == copy_no).write.mode("append").parquet(place)
        stream = spark.readStream.schema(schema).parquet(place)
        # orders go back for years
        latest.start(stream, f"{root}/checkpoint", delay="4000 days", partitions=8).awaitTermination()
    return latest.read(schema).select(
        "order_id", "product", "quantity", "k", "copy_no", F.col("moment").cast("date").cast("string").alias("day"))
