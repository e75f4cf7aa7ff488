import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakestrata.operators import columns as c
from tests.conftest import plan, rows


def test_headers_are_tidied_and_first_repeat_kept(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    out = c.normalize_headers(df, [" Order_ID ", "ORDER_id", "Date"])
    assert out.columns == ["order_id", "date"] and rows(out) == [(1, 3)]


def test_alias_collision_keeps_the_first_column(spark):
    df = spark.createDataFrame([(1, 2, "x", "y")], ["id", "order_id", "name", "product_name"])
    out = c.alias_columns(df)
    assert out.columns == ["order_id", "product"] and rows(out) == [(1, "x")]


def test_candidates_in_order_then_first_column(spark):
    df = spark.createDataFrame([("k", 5.0, "2026-01-02", 7.0)], ["code", "total", "when", "price"])
    out = c.pick_aliases(df)
    # price precedes total among the candidates; the date is found by content.
    assert out.columns == ["order_id", "total", "order_date", "revenue"]


def test_date_column_found_by_any_value(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", "x 2026-01-02 y", 2)], "p string, q string, n int")
    assert c.detect_date_column(df) == "q"
    assert c.detect_date_column(df.select("p", "n")) is None


def test_required_and_projected_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["order_id", "x"])
    assert c.missing_columns(df) == ["order_date"]
    assert c.project_existing(df, ["y", "x", "order_id"]).columns == ["x", "order_id"]


def test_defaults_leave_existing_columns_alone(spark):
    df = spark.createDataFrame([(None,)], "revenue double")
    out = c.with_defaults(df, {"revenue": 1.0, "n": 0})
    assert rows(out) == [(None, 0)]


def test_conform_binds_by_name_and_casts_leniently(spark):
    df = spark.createDataFrame([("abc", "7", "p")], ["revenue", "order_id", "product"])
    out = c.conform(df)
    assert out.columns == ["order_id", "order_date", "product", "revenue"]
    assert rows(out) == [("7", None, "p", None)]


@pytest.mark.parametrize("ages,filled", [([28, 29, None], 28), ([29, 30, None], 30), ([None, None], 0), ([1, 2, 4, None], 2)])
def test_mean_fill_rounds_half_even(spark, ages, filled):
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    out = c.fill_mean(df, "age")
    assert dict(out.dtypes)["age"] == "int"
    assert sorted(r[0] for r in out.collect()) == sorted([a for a in ages if a is not None] + [filled] * ages.count(None))
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


def test_mean_is_taken_after_deduplication_from_one_shuffle(spark):
    df = spark.createDataFrame([(1, 10), (1, 10), (2, 20), (3, None)], "id int, age int")
    out = c.fill_mean(df.dropDuplicates(), "age")
    assert rows(out) == [(1, 10), (2, 20), (3, 15)]


def test_gold_display_form(spark):
    df = spark.createDataFrame(
        [("2026-02-01", "3", "x"), ("2026-01-01", None, "1.5"), ("nope", "1", "1"), (None, "1", "1")],
        ["order_date", "total_orders_per_day", "total_revenue_per_day"])
    out = c.normalize_gold(df)
    assert dict(out.dtypes) == {"date": "timestamp_ntz", "total_orders": "int", "total_revenue": "float"}
    assert [tuple(r) for r in out.select(F.to_date("date").cast("string"), "total_orders", "total_revenue").collect()] == [
        ("2026-01-01", 0, 1.5), ("2026-02-01", 3, 0.0)]
    bare = c.normalize_gold(spark.createDataFrame([("2026-01-01",)], ["date"]))
    assert rows(bare.drop("date")) == [(0, 0.0)]


def test_source_file_is_the_plain_name(spark, files):
    path = files.write({"a b+1%.csv": "x\n1\n"})
    scan = spark.read.option("header", True).csv(path)
    assert rows(c.add_source_file(scan)) == [("1", "a b+1%.csv")]
    assert rows(c.add_source_file(scan, full_path=True))[0][1].endswith("/a b+1%.csv")


def test_fill_constant(spark):
    df = spark.createDataFrame([(None, "a"), (2.0, None)], "revenue double, product string")
    assert rows(c.fill_constant(df, {"revenue": 0.0})) == [(0.0, "a"), (2.0, None)]
    pdf = pd.DataFrame({"revenue": [None, 2.0]}).fillna({"revenue": 0.0})
    assert sorted(pdf["revenue"]) == [0.0, 2.0]
