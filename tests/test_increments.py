import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.gold import gold_daily
from lakestrata.plans.batch import Medallion
from lakestrata.sources.daily import DailyGold
from lakestrata.sources.runs import KeyedTable, RunTable
from tests.conftest import plan, rows

HEADER = "order_id,customer_id,product_name,unit_price,quantity,order_date\n"


def _runs(spark, names):
    return lambda: spark.createDataFrame([(n,) for n in names], "run string")


def test_a_repeated_run_replaces_its_rows_and_columns_come_by_name(spark, folder):
    done = ["a", "b"]
    table = RunTable(spark, folder, _runs(spark, done))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.write(spark.createDataFrame([(1, "x"), (2, "y")], "k int, t string"), "a")
    table.write(spark.createDataFrame([("z", 3, 0.5)], "t string, k int, extra double"), "b")
    table.write(spark.createDataFrame([(4, "w")], "k int, t string"), "lost")
    assert rows(table.read()) == [(1, "x", None), (2, "y", None), (3, "z", 0.5)]
    table.write(spark.createDataFrame([(7, "q")], "k int, t string"), "a")
    assert rows(table.read().select("k")) == [(3,), (7,)]
    assert rows(table.written("lost").select("k")) == [(4,)] and rows(table.runs()) == [("a",), ("b",)]
    assert table.vacuum() == ["lost"] and table.vacuum() == [] and table.written("lost").count() == 0
    with pytest.raises(ValueError):
        table.write(spark.createDataFrame([("k",)], "k string"), "c")


def test_keys_are_looked_up_without_moving_the_table(spark, folder):
    table = KeyedTable(spark, folder, "id", buckets=4)
    new = spark.range(40).selectExpr("cast(id as string) AS id", "id AS n")
    assert rows(table.without_known(new)) == rows(new)
    table.write(new.where("n < 20"), "a")
    table.write(new.where("n < 10").withColumn("more", F.lit(1)), "b")  # a column more: the table is made anew
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = KeyedTable(spark, folder, "id", buckets=4).without_known(new.withColumn("x", F.lit(2)))
        assert rows(found.select("n")) == [(n,) for n in range(20, 40)] and found.columns == ["id", "n", "x"]
        # the only exchange is that of the given rows
        text = plan(found)
        assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
        held = text[text.rindex("Sort [id"):]
        assert "Exchange" not in held and "ReadSchema: struct<id:string>" in held
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    parts = [p.name for p in Path(folder).glob("rows/run=a/*.parquet")]
    assert len(parts) <= 4
    assert rows(table.without_known(new.where("n < 0"))) == []


def test_gold_of_runs_equals_gold_of_all_rows(spark, folder):
    done = []
    gold = DailyGold(spark, folder, lambda: spark.createDataFrame([(n,) for n in done], "run string"))
    assert gold.read().count() == 0
    days = ["2026-01-01", "2026-01-02", "2026-02-01", None, "invalid"]
    orders = spark.range(300).selectExpr("cast(id as string) AS order_id", "cast(id as double) AS revenue", "id")
    orders = orders.withColumn("order_date", F.element_at(F.array(*[F.lit(d) for d in days]), (F.col("id") % 5 + 1).cast("int")))
    day = F.col("order_date").try_cast("date")
    for run in range(4):
        part = gold_daily(orders.where(F.col("id") % 4 == run), day)
        gold.apply(part, f"dead{run}")  # this one is never recorded
        gold.apply(part, f"run{run}")
        gold.apply(part, f"run{run}")  # the run died and is repeated under its name
        done.append(f"run{run}")
    assert rows(gold.read()) == rows(gold_daily(orders, day))
    assert gold._parts().groupBy("order_date").count().where("count > 3").isEmpty()


def test_a_run_opens_only_the_months_and_orders_it_adds(spark, files, folder):
    path = files(**{"a.csv": HEADER + "".join(f"{i},9,P,5,1,2026-01-{1 + i % 9:02}\n" for i in range(30))})
    m = Medallion(spark, folder, buckets=4)
    m.run(path)
    for part in Path(f"{folder}/gold/order_month=2026-01").glob("*.parquet"):
        part.write_bytes(b"not to be opened")  # a run that read this month would fail
    files(**{"b.csv": HEADER + "99,9,P,5,2,2026-03-01\n"})
    m.run(path)
    new = m.gold.touched(["2026-03"])
    assert rows(new.select("total_orders_per_day")) == [(1,)]
    assert re.search(r"PartitionFilters: \[[^\]]*order_month", plan(new))
    last = [r["run"] for r in m.silver.runs().collect()]
    assert sorted(m.silver.written(run).count() for run in last) == [1, 30]
    assert re.search(r"PartitionFilters: \[[^\]]*run", plan(m.silver.written(last[0])))
