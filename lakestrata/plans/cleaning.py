"""Single-file cleaning jobs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.parsing import as_day
from lakestrata.operators.columns import add_processing_time, fill_mean, with_defaults
from lakestrata.operators.dedup import dedup_full_row
from lakestrata.operators.gold import gold_daily
from lakestrata.sources.sinks import write_parquet
from lakestrata.sources.tabular import scan_csv_inferred, scan_parquet


def clean_job(
    spark: SparkSession, csv_path: str, output_path: str, fill_column: str = "age",
) -> DataFrame:
    """CSV with inferred types, distinct rows, nulls filled by the mean, stamped, saved as Parquet."""
    rows = fill_mean(dedup_full_row(scan_csv_inferred(spark, csv_path)), fill_column)
    write_parquet(add_processing_time(rows, "processed_time"), output_path)
    return scan_parquet(spark, output_path)


def daily_gold_job(spark: SparkSession, csv_path: str, key: str = "id") -> DataFrame:
    """Distinct rows of a CSV to daily gold; without a date the ingestion day counts, revenue is 0."""
    rows = add_processing_time(
        dedup_full_row(scan_csv_inferred(spark, csv_path)), "ingestion_timestamp")
    rows = with_defaults(rows, {
        "order_date": F.to_date("ingestion_timestamp"), "revenue": F.lit(0.0).cast("double")})
    return gold_daily(rows, as_day("order_date"), key)
