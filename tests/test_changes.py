from lakestrata.operators.changes import keyed_changes
from lakestrata.sources.runs import KeyedTable
from tests.conftest import plan, rows


def test_every_kind_of_change(spark):
    old = spark.createDataFrame([(1, "a", 1.0, 9), (2, "b", None, 9), (3, "c", 3.0, 9), (None, "n", 1.0, 9), (5, "x", 1.0, 9), (5, "y", 1.0, 9)],
                                "id int, name string, price double, stamp int")
    new = spark.createDataFrame([(1, "a", 1.0, "t", 8), (2, "B", 2.0, None, 8), (4, "d", 4.0, "t", 8), (None, "n", 1.0, None, 8),
                                 (5, "x", 1.0, None, 8), (5, "z", 1.0, None, 8)], "id int, name string, price double, tag string, stamp int")
    got = keyed_changes(old, new, "id", ignore=["stamp"])
    assert rows(got.select("id", "change", "changed", "old.name", "new.name")) == sorted([
        (1, "update", ["tag"], "a", "a"), (2, "update", ["name", "price"], "b", "B"), (3, "delete", None, "c", None),
        (4, "insert", None, None, "d"), (5, "update", ["name"], "y", "z")], key=repr)
    assert keyed_changes(new, new, "id").count() == 0
    assert keyed_changes(old.limit(0), new, "id").where("change = 'insert'").count() == 6
    assert keyed_changes(old, new.limit(0), "id").where("change = 'delete'").count() == 6


def test_bucketed_versions_are_not_moved(spark, folder):
    tables = []
    for name, scale in (("one", 1), ("two", 2)):
        tables.append(KeyedTable(spark, f"{folder}/{name}", "id", buckets=4))
        tables[-1].write(spark.range(50).selectExpr("cast(id as string) AS id", f"id * {scale} AS n"), "a")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = keyed_changes(tables[0].read(), tables[1].read(), "id", unique=True)
        assert found.where("change = 'update'").count() == 49
        assert "Exchange hashpartitioning" not in plan(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
