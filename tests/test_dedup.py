import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakestrata.operators import dedup as d
from lakestrata.operators import quality as q
from tests.conftest import plan, rows

SCHEMA = "order_id string, order_date string, v int, pos int"
ROWS = st.lists(st.tuples(
    st.sampled_from([None, "1", "2", "3", "4"]), st.sampled_from([None, "2026-01-01", "2026-01-02"]),
    st.integers(0, 2)), min_size=1, max_size=25)
QUICK = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def _frames(spark, data):
    data = [(*row, i) for i, row in enumerate(data)]
    return spark.createDataFrame(data, SCHEMA), pd.DataFrame(data, columns=["order_id", "order_date", "v", "pos"])


def _set(pdf):
    return sorted([tuple(None if pd.isna(x) else x for x in r) for r in pdf.itertuples(index=False)], key=repr)


@QUICK
@given(ROWS)
def test_first_per_key_and_composite_key(spark, data):
    df, pdf = _frames(spark, data)
    assert rows(d.dedup_by_key(df, order_by=["pos"])) == _set(pdf.drop_duplicates(["order_id"]))
    assert rows(d.dedup_composite(df, order_by=["pos"])) == _set(pdf.drop_duplicates(["order_id", "order_date"]))


@QUICK
@given(ROWS)
def test_latest_wins(spark, data):
    df, pdf = _frames(spark, data)
    pdf = pdf.dropna(subset=["order_date"]).sort_values("order_date", ascending=False, kind="stable")
    got = d.dedup_latest(df.where("order_date is not null"), "order_id", "order_date", ["pos"])
    assert rows(got) == _set(pdf.drop_duplicates(["order_id"]))


@QUICK
@given(ROWS)
def test_duplicate_numbers(spark, data):
    df, pdf = _frames(spark, data)
    members = int(pdf.duplicated(["order_id"], keep=False).sum())
    surplus = len(pdf) - len(pdf.drop_duplicates(["order_id"]))
    assert q.duplicate_surplus(df).select("surplus").first()[0] == surplus
    got = q.duplicate_members(df, order_by=["pos"]).first()
    assert got["members"] == members
    ids = pdf.loc[pdf.duplicated(["order_id"], keep=False), "order_id"].unique().tolist()
    assert got["ids"] == len(ids)
    assert (got["sample_ids"] or "") == ", ".join(str(x) for x in ids[:5])
    report = d.duplicate_report(df, order_by=["pos"])
    counts = pdf["order_id"].value_counts()
    want = {k: int(n) for k, n in counts.items() if n > 1}
    assert {r["order_id"]: r["Occurrences"] for r in report.collect()} == want
    first = pdf.drop_duplicates(["order_id"]).set_index("order_id")["pos"]
    assert all(r["pos"] == first[r["order_id"]] for r in report.collect())


def test_full_row_and_missing_keys(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], ["a", "b"])
    assert rows(d.dedup_full_row(df)) == [(1, 2), (1, 3)]
    assert rows(d.dedup_composite(df)) == [(1, 2), (1, 3)]


def test_composite_falls_back_to_the_key_that_exists(spark):
    df = spark.createDataFrame([(1, 2), (1, 1), (2, 5)], ["order_id", "b"])
    assert rows(d.dedup_composite(df, order_by=["b"])) == [(1, 1), (2, 5)]


@pytest.mark.parametrize("policy", [
    lambda df: d.dedup_by_key(df, "k"), lambda df: d.dedup_latest(df, "k", "v"),
    lambda df: d.dedup_composite(df, ["k", "v"])])
def test_hot_keys_are_cut_down_before_the_shuffle(spark, policy):
    """A key with most of the rows leaves each map task as one row."""
    df = spark.range(40_000, numPartitions=8).selectExpr("if(id % 10 < 9, null, id) AS k", "id % 3 AS v", "id")
    out = policy(df)
    assert "Partial" in plan(out).split("Exchange")[-1]
    out.collect()
    final = plan(out).split("Initial Plan")[0]
    assert final.count("WindowGroupLimit") == 2
    assert out.where("k is null").count() in (1, 3)


def test_survivors_do_not_depend_on_partitioning(spark):
    df = spark.range(1000).selectExpr("id % 50 AS order_id", "id % 7 AS a", "id AS b")
    once = rows(d.dedup_by_key(df.repartition(3)))
    assert once == rows(d.dedup_by_key(df.repartition(11, "b")))
