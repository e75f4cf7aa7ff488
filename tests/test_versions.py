import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestrata import constants as const
from lakestrata.operators import asof
from lakestrata.sources import versioned as v
from tests.conftest import plan, rows

VALIDATED = [(0, 1773431527465, 417), (1, 1773431601101, 417), (2, 1773431613612, 417),
             (3, 1773431766975, 418), (4, 1773431779813, 418), (5, 1773431902211, 418)]
QUARANTINE = [(0, 1773431761280, 1), (1, 1773431775130, 1), (2, 1773431898303, 1)]
COMMITS = "version bigint, timestamp bigint, total_rows bigint"


def _known(spark):
    return spark.createDataFrame(VALIDATED, COMMITS), spark.createDataFrame(QUARANTINE, COMMITS)


def test_known_commit_pairs(spark):
    got = asof.accepted_vs_rejected(*_known(spark)).select("version", "rejected_version", "rejected_rows")
    assert rows(got) == [(0, None, 0), (1, 1, 1), (2, 1, 1), (3, 2, 1), (4, 2, 1), (5, 2, 1)]


def test_known_trend(spark):
    got = [tuple(r) for r in v.version_trend(*_known(spark)).drop("version_no").collect()]
    assert got == [("v1", "19:53:21", 417, 1), ("v2", "19:53:33", 417, 1), ("v3", "19:56:06", 418, 1),
                   ("v4", "19:56:19", 418, 1), ("v5", "19:58:22", 418, 1)]


TIMES = st.lists(st.integers(0, 4 * asof.BUCKET_MS), max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(TIMES, TIMES, st.sampled_from([0, 180000, 2 * asof.BUCKET_MS]))
def test_asof_against_brute_force(spark, left, right, tolerance):
    l = spark.createDataFrame(list(enumerate(left)), "version bigint, timestamp bigint")
    r = spark.createDataFrame(list(enumerate(right)), "version bigint, timestamp bigint")
    want = []
    for i, t in enumerate(left):
        fits = [(s, j) for j, s in enumerate(right) if s <= t + tolerance]
        want.append((i, max(fits)[1] if fits else None))
    got = asof.asof_join(l, r, tolerance_ms=tolerance).select("version", "q_version")
    assert rows(got) == sorted(want, key=repr)


def test_asof_with_a_hot_time(spark):
    """Most rows share one time; they meet as one record before the window."""
    left = spark.range(30_000).selectExpr("id AS version", "if(id % 10 < 9, 5000000, id) AS timestamp")
    right = spark.range(20_000).selectExpr("id AS version", "if(id % 2 = 0, 4999999, id) AS timestamp")
    out = asof.asof_join(left, right)
    assert out.count() == 30_000
    assert out.where("timestamp = 5000000").select("q_version").distinct().collect()[0][0] == 19998
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


def test_append_overwrite_restore_and_travel(spark, folder):
    t = v.VersionedTable(spark, folder)
    assert t.latest_version() == -1 and t.history().count() == 0
    with pytest.raises(FileNotFoundError):
        t.read()
    a, b, c = (spark.createDataFrame([(x,)], "x int") for x in (1, 2, 3))
    assert [t.append(a), t.append(b), t.overwrite(c)] == [0, 1, 2]
    assert t.restore(1) == 3
    assert t.append(c) == 4
    content = [rows(t.read(n)) for n in range(5)]
    assert content == [[(1,)], [(1,), (2,)], [(3,)], [(1,), (2,)], [(1,), (2,), (3,)]]
    assert [r["total_rows"] for r in t.commits().orderBy("version").collect()] == [1, 2, 1, 2, 3]
    assert [r["num_rows"] for r in t.commits().orderBy("version").collect()] == [1, 1, 1, 0, 1]
    with pytest.raises(FileNotFoundError):
        t.read(9)
    with pytest.raises(FileNotFoundError):
        t.restore(9)


def test_history_form(spark, folder):
    t = v.VersionedTable(spark, folder)
    for _ in range(2):
        t.overwrite(spark.range(3))
    shown = v.with_pending(t.history()).collect()
    assert t.history().columns == const.HISTORY_COLUMNS
    assert [r["version"] for r in shown] == ["Pending", "1", "0"] and shown[0]["operation"] == "INGESTION"
    assert shown[1]["operationParameters"] == '{"mode":"Overwrite"}' and shown[1]["isBlindAppend"] is False
    commit = t.commits().first()
    assert commit["num_files"] >= 1 and commit["num_bytes"] > 0


def test_new_column_reads_as_null_in_old_rows(spark, folder):
    t = v.VersionedTable(spark, folder)
    t.append(spark.createDataFrame([(1,)], "x int"))
    t.append(spark.createDataFrame([("c", 2)], "code string, x int"))
    assert rows(t.read()) == [(1, None), (2, "c")] and t.read(0).columns == ["x"]
    with pytest.raises(ValueError):
        t.append(spark.createDataFrame([("no",)], "x string"))
    assert t.read().count() == 2


def test_data_without_a_commit_is_invisible_and_replaced(spark, folder):
    t = v.VersionedTable(spark, folder)
    t.append(spark.range(2))
    spark.range(100).write.parquet(f"{folder}/data/version=1")
    assert t.read().count() == 2 and t.latest_version() == 0
    assert t.append(spark.range(3)) == 1
    assert t.read().count() == 5


def test_second_writer_of_a_version_fails(spark, folder):
    t = v.VersionedTable(spark, folder)
    t.append(spark.range(1))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        t._record(0, "WRITE", {}, [(0, 0)], spark.range(1).schema.json(), True, 1, 1, 1, 1, None)


def test_reading_a_version_opens_only_its_folders(spark, folder):
    t = v.VersionedTable(spark, folder)
    for _ in range(3):
        t.append(spark.range(1))
    assert all("version=2" not in name for name in t.read(1).inputFiles())


def test_diff_counts_copies(spark, folder):
    t = v.VersionedTable(spark, folder)
    t.overwrite(spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int"))
    t.overwrite(spark.createDataFrame([(1,), (3,), (None,), (None,)], "x int"))
    assert rows(t.diff(0, 1)) == sorted([(1, "removed"), (2, "removed"), (3, "added"), (None, "added")], key=repr)
    t.append(spark.createDataFrame([(4,)], "x int"))
    d = t.diff(1, 2)
    assert rows(d) == [(4, "added")]


def test_ratio_per_version(spark):
    clean, bad = _known(spark)
    scores = spark.createDataFrame([(5, 3, 4)], "version bigint, passing int, checks_run int")
    got = {r["version"]: r for r in v.rca_trend(clean, bad, scores).collect()}
    assert got[5]["dq_score"] == 0.75 and got[0]["dq_score"] is None and got[0]["rejection_ratio"] == 0.0
    assert abs(got[5]["rejection_ratio"] - 1 / 419) < 1e-12


def test_random_appends_match_a_plain_union(spark, folder):
    rng = random.Random(5)
    t, want = v.VersionedTable(spark, folder), []
    for _ in range(4):
        part = [(rng.randint(0, 5),) for _ in range(rng.randint(1, 4))]
        df = spark.createDataFrame(part, "x int")
        if rng.random() < 0.3:
            t.overwrite(df)
            want = part
        else:
            t.append(df)
            want = want + part
    assert rows(t.read()) == sorted(want, key=repr)
    assert t.commits().orderBy(F.desc("version")).first()["total_rows"] == len(want)
