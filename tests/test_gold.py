import pandas as pd
from pyspark.sql import functions as F

from lakestrata.operators import gold as g
from lakestrata.operators.rules import date_range_filter
from lakestrata.sources import sinks
from lakestrata.sources.tabular import partition_scan
from tests.conftest import plan, rows


def test_daily_gold_counts_ids_and_defaults_revenue(spark):
    df = spark.createDataFrame([("1", "d1", 2.0, 3), (None, "d1", 1.0, 1), ("2", None, 1.0, 1)],
                               "order_id string, order_date string, unit_price double, quantity int")
    assert rows(g.gold_daily(df)) == [("d1", 1, 7.0)]
    assert rows(g.gold_daily(df.drop("quantity"))) == [("d1", 1, 0.0)]
    assert rows(g.gold_daily(df.withColumn("revenue", F.lit("x")))) == [("d1", 1, 0.0)]


def test_a_day_is_one_row_whatever_its_size(spark):
    """A third of all ids on one day."""
    df = spark.range(900).selectExpr(
        "CAST(id AS string) AS order_id",
        "if(id % 3 = 0, '2026-01-01', CAST(date_add(DATE '2026-02-01', CAST(id % 60 AS int)) AS string)) AS order_date")
    daily = g.gold_daily_latest(df)
    heavy = daily.where("date = DATE '2026-01-01'").collect()
    assert [(r["total_orders"], r["last_processed"]) for r in heavy] == [(300, "2026-01-01 00:00:00")]
    assert g.monthly_orders(daily).where("month = DATE '2026-01-01'").first()["total_orders"] == 300
    ids = g.gold_daily_ids(df)
    assert ids.count() == ids.distinct().count() == 900
    assert ids.where("date = DATE '2026-01-01'").count() == 300


def test_null_ids_count_as_one_order(spark):
    df = spark.createDataFrame([(None, "2026-01-01"), (None, "2026-01-01"), ("b", "2026-01-01"), ("a", "2026-01-01 05:00:00"), ("c", "x")],
                               "order_id string, order_date string")
    assert rows(g.gold_daily_latest(df).drop("date")) == [(3, "2026-01-01 05:00:00")]
    assert rows(g.gold_daily_ids(df).select("order_id")) == sorted([("a",), ("b",), (None,)], key=repr)


def test_latest_row_decides_the_day(spark):
    df = spark.createDataFrame([("1", "2026-01-01"), ("1", "2026-01-05"), ("1", "bad")], "order_id string, order_date string")
    assert [str(r["date"]) for r in g.gold_daily_ids(df).collect()] == ["2026-01-05"]


def test_growth_against_the_previous_existing_month(spark):
    daily = pd.DataFrame({"date": pd.to_datetime(["2025-10-01", "2026-01-01", "2026-01-09", "2026-02-01", "2026-03-01"]),
                          "total_orders": [4, 30, 10, 28, 28]})
    df = spark.createDataFrame(daily).withColumn("date", F.to_date("date"))
    out = g.mom_growth(g.monthly_orders(df))
    assert [(r["month_label"], r["total_orders"], r["growth_text"]) for r in out.collect()] == [
        ("Jan 2026", 40, "+900.0%"), ("Feb 2026", 28, "-30.0%"), ("Mar 2026", 28, "+0.0%")]
    first = g.mom_growth(g.monthly_orders(df), last=None).first()
    assert first["growth_pct"] is None and first["growth_text"] == ""


def test_growth_from_zero_is_null(spark):
    df = spark.createDataFrame([("2026-01-01", 0), ("2026-02-01", 5)], "m string, total_orders int").selectExpr("cast(m as date) AS month", "total_orders")
    assert [r["growth_pct"] for r in g.mom_growth(df).collect()] == [None, None]


def test_label_rounds_half_even_on_the_exact_value(spark):
    from lakestrata.functions.text import growth_label, ratio_pct
    values = [-6.25, 16.15, 0.05, -0.04, 12.35, 100.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(growth_label("v")).collect()]
    assert got == [f"{v:+.1f}%" for v in values]
    pairs = [(1, 800), (1, 3), (101, 417), (0, 0), (5, 100)]
    got = [r[0] for r in spark.createDataFrame(pairs, "a int, b int").select(ratio_pct(F.col("a"), F.col("b"))).collect()]
    assert got == [round(a / b * 100, 2) if b else 0.0 for a, b in pairs]


def test_funnel_and_summary(spark):
    bronze, silver = spark.range(5), spark.range(3)
    assert [tuple(r) for r in g.layer_funnel(bronze, silver).collect()] == [("Bronze", 5), ("Rejected", 2), ("Silver", 3)]
    assert rows(g.layer_funnel(bronze.limit(0), silver)) == [("Empty", 1)]
    assert rows(g.layer_funnel(silver, bronze))[1] == ("Rejected", 0)
    daily = spark.createDataFrame([(2,), (1,)], "total_orders int")
    got = g.run_summary(spark.range(2), bronze, silver, daily).first().asDict()
    assert got == {"files": 2, "raw_records": 5, "unique_records": 3, "daily_orders": 3, "duplicates_filtered": 2}


def test_partition_numbers(spark, folder):
    df = spark.sql("SELECT date_add(DATE '2026-01-01', CAST(id AS int)) AS date, 2 AS total_orders FROM range(10)")
    sinks.write_partitioned(df, folder, by=["date"])
    got = partition_scan(spark, folder, "date", "2026-01-02", "2026-01-04", "total_orders").first()
    assert (got["total_partitions"], got["partitions_scanned"], got["filtered_total"], got["scan_pct"], got["pruning"]) == (
        10, 3, 6, 30.0, "PASS")
    assert partition_scan(spark, folder, "date", "2000-01-01", "2030-01-01", "total_orders").first()["pruning"] == "ACTIVE"
    total = g.date_range_total(df, "2026-01-02", "2026-01-04").first()
    assert (str(total["first_date"]), str(total["last_date"]), total["filtered_total"]) == ("2026-01-01", "2026-01-10", 6)


def test_day_folders_prune_a_date_range(spark, folder):
    df = spark.sql("SELECT date_add(DATE '2026-01-01', CAST(id AS int)) AS order_date, id FROM range(10)")
    sinks.write_partitioned(df, folder)
    picked = date_range_filter(spark.read.parquet(folder), "order_date", "2026-01-02", "2026-01-04")
    assert "PartitionFilters: [isnotnull(order_date" in plan(picked)
    assert picked.count() == 3
    assert picked.select(F.input_file_name().alias("f")).distinct().count() == 3
    default = date_range_filter(spark.read.parquet(folder), "order_date")
    assert "dynamicpruning" in plan(default) or "PartitionFilters" in plan(default)
    assert default.count() == 10


def test_preview_is_a_top_n(spark):
    out = g.preview(spark.range(100).selectExpr("100 - id AS x"), ["x"], 3)
    assert [r[0] for r in out.collect()] == [1, 2, 3] and "TakeOrderedAndProject" in plan(out)
