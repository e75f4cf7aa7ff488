import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakestrata.sources import footers
from tests.conftest import plan, rows


def _written(df, folder, *by):
    df.write.partitionBy(*by).parquet(folder)
    return folder


def test_totals_come_from_footers(spark, folder):
    df = spark.range(1000).select(
        (F.col("id") % 3).alias("part"), F.col("id").alias("k"), F.when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("odd.name"),
        F.expr("date_add(date'2024-01-01', cast(id as int))").alias("day"), (F.col("id") / 2).alias("half"), F.array("id").alias("list"))
    path = _written(df, folder, "part")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    want = footers.totals(df, by=["part"])
    got = footers.footer_totals(spark, path, by=["part"])
    assert got.columns == ["part", "rows", "k_held", "k_low", "k_high", "odd.name_held", "day_held", "day_low", "day_high", "half_held"]
    assert rows(got) == rows(want) and got.count() == 3
    assert rows(footers.footer_totals(spark, path, ["day"])) == [(1000, 1000, datetime.date(2024, 1, 1), datetime.date(2026, 9, 26))]
    with footers.pushdown(spark):
        text = plan(footers.totals(spark.read.parquet(path), by=["part"]))
    assert "PushedAggregation: [COUNT(*), COUNT(k), MIN(k), MAX(k)" in text and "PushedGroupBy: [part]" in text
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_settings_come_back_after_a_failure(spark, folder):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with pytest.raises(PySparkException):
        footers.footer_totals(spark, folder + "/nothing")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_columns_of_nulls_and_empty_tables(spark, folder):
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "a int, b int")
    assert rows(footers.footer_totals(spark, _written(nulls, folder + "/n"))) == [(2, 0, None, None, 2, 1, 2)]
    empty = _written(nulls.limit(0), folder + "/e")
    assert rows(footers.footer_totals(spark, empty)) == [(0, 0, None, None, 0, None, None)]
    assert rows(footers.footer_totals(spark, empty, ["b"], by=["a"])) == []
