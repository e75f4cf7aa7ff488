from pyspark.sql import functions as F

from lakestrata.streaming.latest import LatestRows
from tests.conftest import rows

SCHEMA = "id string, at timestamp, n int, note string"


def test_the_newest_row_wins_across_batches_restarts_and_late_rows(spark, folder):
    place = f"{folder}/in"
    latest = LatestRows(spark, f"{folder}/out", "id", "at", ["n"])

    def run(*given, delay="10 days"):
        day = F.to_timestamp("at")
        spark.createDataFrame(given, "id string, at string, n int, note string").withColumn("at", day).coalesce(1).write.mode(
            "append").parquet(place)
        events = spark.readStream.schema(SCHEMA).parquet(place)
        latest.start(events, f"{folder}/checkpoint", delay, partitions=2).awaitTermination()
        return rows(latest.read(SCHEMA).select("id", F.date_format("at", "MM-dd"), "n", "note"))

    first = run(("a", "2026-01-05", 1, "x"), ("a", "2026-01-04", 9, "old"), ("b", "2026-01-03", 1, None), (None, "2026-01-03", 1, "-"),
                ("c", None, 1, "-"), ("a", "2026-01-05", 1, "x"))
    assert first == [("a", "01-05", 1, "x"), ("b", "01-03", 1, None)]
    # restarted: older and equal rows change nothing, a tie goes to the greater n, a late row within the delay counts
    assert run(("a", "2026-01-02", 5, "late"), ("b", "2026-01-03", 10, "tie"), ("d", "2026-01-01", 1, "late")) == [
        ("a", "01-05", 1, "x"), ("b", "01-03", 10, "tie"), ("d", "01-01", 1, "late")]
    assert run(("e", "2026-03-01", 1, "far")) == [("a", "01-05", 1, "x"), ("b", "01-03", 10, "tie"), ("d", "01-01", 1, "late"), ("e", "03-01", 1, "far")]
    # the watermark is at 02-19 now: a row from before is left out, newer ones count although the state was given up
    got = run(("f", "2026-01-20", 1, "too late"), ("a", "2026-02-25", 2, "new"), ("a", "2026-02-20", 3, "not newest"))
    assert [r for r in got if r[0] in "af"] == [("a", "02-25", 2, "new")]
    changes = latest.changes.read()
    assert changes.where("key = 'a'").count() == 2  # only rows that beat the newest are handed on


def test_many_keys_share_a_row_of_state(spark, folder):
    """A row of state per key took some milliseconds of trips for each."""
    latest, n = LatestRows(spark, f"{folder}/out", "id", "at", ["n"]), 20_000
    events = spark.range(n).selectExpr("cast(id as string) AS id", "timestamp'2026-01-05' + make_dt_interval(0, 0, 0, id % 7) AS at",
                                       "cast(id % 3 as int) AS n", "'x' AS note")
    later = events.where("id % 10 < 2").selectExpr("id", "if(id % 10 = 0, at, at - interval 1 hour) AS at", "n + 1 AS n", "'y' AS note")
    for part in (events, later):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
        latest.start(stream, f"{folder}/checkpoint", "10 days", partitions=2, groups=16).awaitTermination()
    found = latest.read(SCHEMA)
    assert found.count() == n and found.where("note = 'y'").count() == n // 10
    assert latest.changes.read().count() == n + n // 10
    state = spark.read.format("statestore").option("stateVarName", "newest").load(f"{folder}/checkpoint")
    assert state.count() == 16
