"""Parquet and report sinks."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> None:
    """Overwrite ``path``."""
    df.write.mode("overwrite").parquet(path)


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str] = ("order_date",), tasks: int | None = None
) -> None:
    """Overwrite ``path`` with one folder per value.

    The rebalance hint gathers each value's rows into few files and lets adaptive execution split a
    value that is too large for one task. It goes by bytes: for many folders of few rows, as in daily
    gold, give the number of ``tasks`` to share the folders among.
    """
    spread = df.repartition(tasks, *by) if tasks else df.hint("rebalance", *by)
    spread.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """The nested one-row report as a JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def report_json(report: DataFrame) -> DataFrame:
    """The report as indented JSON text."""
    return report.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("report"))
