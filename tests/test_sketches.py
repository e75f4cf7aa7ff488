import datetime

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import sketches as sk
from lakestrata.sources.profiles import Profiles
from lakestrata.sources.versioned import VersionedTable
from tests.conftest import rows


def _exact(df, name):
    values = [r[0] for r in df.select(name).collect() if r[0] is not None]
    return len(values), len(set(values)), sorted(values)


def test_parts_unite_to_the_profile_of_the_whole(spark):
    df = spark.range(0, 60000, 1, 9).select(
        F.col("id").alias("k"), (F.col("id") % 777).alias("few"), F.when(F.col("id") % 3 != 0, F.concat(F.lit("v"), F.col("id"))).alias("t"),
        F.when(F.col("id") % 2 == 0, F.pow(F.col("id").cast("double"), 2)).alias("square"))
    whole = {r["column"]: r for r in sk.sketched_profile(sk.column_sketches(df)).collect()}
    halves = sk.column_sketches(df.where("k < 20000")).unionByName(sk.column_sketches(df.where("k >= 20000")))
    united = {r["column"]: r for r in sk.sketched_profile(sk.united(halves)).collect()}
    for name in df.columns:
        present, distinct, values = _exact(df, name)
        for profile in (whole[name], united[name]):
            assert (profile["rows"], profile["nulls"]) == (60000, 60000 - present)
            assert profile["distinct_from"] <= distinct <= profile["distinct_to"]
            assert abs(profile["distinct_values"] - distinct) <= sk.distinct_error() * distinct
            assert abs(profile["surplus"] - (present - distinct)) <= sk.distinct_error() * distinct
            if name == "t":
                assert profile["median"] is None and profile["low"] is None
                continue
            assert (profile["low"], profile["high"]) == (values[0], values[-1])
            for quantile, rank in sk.QUANTILES.items():
                below = sum(v < profile[quantile] for v in values) / present
                upto = sum(v <= profile[quantile] for v in values) / present
                assert below - sk.RANK_ERROR <= rank <= upto + sk.RANK_ERROR


def test_kinds_of_columns_and_odd_values(spark):
    day, moment = datetime.date(1970, 1, 11), datetime.datetime(1970, 1, 1, 0, 1, 0, 500000)
    df = spark.createDataFrame(
        [("", float("nan"), day, moment, True, [1], {"a": 1}), (None, 0.0, None, None, None, None, None), ("", -0.0, day, moment, False, [2], {"a": 1})],
        "text string, `odd.name` double, day date, at timestamp, flag boolean, list array<int>, map map<string,int>")
    got = {r["column"]: r for r in sk.sketched_profile(sk.column_sketches(df)).collect()}
    assert {n: r["distinct_values"] for n, r in got.items()} == {
        "text": 1, "odd.name": 2, "day": 1, "at": 1, "flag": 2, "list": 2, "map": 1}
    assert got["day"]["low"] == 10.0 and got["at"]["high"] == 60.5 and got["flag"]["low"] is None
    assert got["text"]["nulls"] == 1 and got["text"]["null_pct"] == 33.33


def test_empty_tables_and_columns_of_nulls(spark):
    empty = spark.createDataFrame([], "a int, b string")
    got = rows(sk.sketched_profile(sk.column_sketches(empty)).select("column", "rows", "nulls", "distinct_values", "surplus", "median"))
    assert got == [("a", 0, 0, 0, 0, None), ("b", 0, 0, 0, 0, None)]
    nulls = spark.createDataFrame([(None, None)] * 3, "a int, b string")
    # an empty part changes nothing
    both = sk.united(sk.column_sketches(nulls).unionByName(sk.column_sketches(empty)))
    assert rows(sk.sketched_profile(both).select("column", "rows", "nulls", "distinct_values", "low")) == [("a", 3, 3, 0, None), ("b", 3, 3, 0, None)]
    with pytest.raises(ValueError):
        sk.column_sketches(empty, [])


def test_a_version_is_profiled_without_its_data(spark, folder):
    table = VersionedTable(spark, folder)
    table.append(spark.range(100).selectExpr("id AS k"))
    table.append(spark.range(50, 150).selectExpr("id AS k", "id % 4 AS more"))
    table.overwrite(spark.range(7).selectExpr("id AS k"))
    table.restore(1)
    profiles = Profiles(table)
    assert profiles.note(1) == [0, 1] and profiles.note(3) == [] and profiles.note() == []
    got = profiles.profile()
    assert rows(got.select("column", "rows", "nulls", "low", "high")) == [("k", 200, 0, 0.0, 149.0), ("more", 200, 100, 0.0, 3.0)]
    assert [r["distinct_values"] for r in got.orderBy("position").collect()] == [150, 4]
    assert all("/sketches/" in name for name in got.inputFiles())
    assert rows(profiles.profile(0).select("column", "rows", "distinct_values")) == [("k", 100, 100)]
    assert rows(profiles.profile(2).select("rows")) == [(7,)]
    with pytest.raises(FileNotFoundError):
        profiles.profile(9)
