from pyspark.sql import functions as F

from lakestrata.operators import audit as a
from tests.conftest import plan, rows


def _expected(lines):
    """The log view as plain Python: (section, distance from the end, text)."""
    words = ["ERROR", "CRITICAL", "EXCEPTION", "SPARK", "FAILED", "JAVA", "PYTHON"]
    recent = list(enumerate(reversed(lines), start=1))[:500]
    hits = [(n, x) for n, x in recent if any(w in x.upper() for w in words)][:15]
    return sorted([("highlight", n, x.strip()) for n, x in hits] + [("tail", n, x) for n, x in recent[:40]], key=repr)


def test_log_view_of_text_files(spark, files):
    long = [f" line {i} {'Java trace' if i % 37 == 0 else 'fine'}" for i in range(700)]
    short = ["a", "failed here ", "b"]
    path = files(**{"x.log": "\n".join(long) + "\n", "y.log": "\n".join(short) + "\n"})
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("source"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"), F.col("value").alias("line"))
    out = a.log_highlights(lines, order_by=["block", "position"])
    for name, text in (("x.log", long), ("y.log", short)):
        got = rows(out.where(F.col("source") == name).select("section", "from_end", "line"))
        assert got == _expected(text)


def test_hot_log_is_cut_before_the_shuffle(spark):
    lines = spark.range(20_000).selectExpr("if(id % 3 = 0, 'hot', string(id % 50)) AS source", "id AS position", "'error' AS line")
    out = a.log_highlights(lines)
    assert out.where("source = 'hot'").count() == 55
    out.collect()
    assert plan(out).split("Initial Plan")[0].count("WindowGroupLimit") == 2


def test_run_log(spark):
    events = spark.createDataFrame(
        [("d", "RUNNING", "r1", "t1", "2026-01-01 00:00:00"), ("d", "ERROR", "r1", "t2", "2026-01-01 00:01:30"),
         ("e", "SUCCESS", "r2", "t1", "2026-01-01 00:00:00")],
        "dag_id string, status string, run_id string, task_id string, ts string").withColumn("timestamp", F.col("ts").cast("timestamp"))
    assert rows(a.run_status_latest(events).select("dag_id", "status")) == [("d", "ERROR"), ("e", "SUCCESS")]
    assert rows(a.run_durations(events).select("run_id", "duration_seconds", "task_count")) == [("r1", 90.0, 2), ("r2", 0.0, 1)]


def test_inspection_labels_both_sides(spark):
    valid = spark.range(100).withColumnRenamed("id", "k")
    bad = spark.createDataFrame([(5, "why")], "k bigint, rejection_reason string")
    out = a.record_inspection(valid, bad, ["k"], 3)
    assert rows(out.select("record_state", "k", "rejection_reason")) == [
        ("rejected", 5, "why"), ("valid", 0, None), ("valid", 1, None), ("valid", 2, None)]


def test_jobs_write_the_run_log(spark, folder):
    log = a.RunLog(spark, f"{folder}/runs")
    assert log.events().count() == 0
    with log.task("good", "t"):
        pass
    try:
        with log.task("bad", "t"):
            raise ValueError("why")
    except ValueError:
        pass
    latest = a.run_status_latest(log.events(), order_by=["timestamp", "status"]).where("dag_id = 'good'")
    assert rows(latest.select("status")) == [("SUCCESS",)]
    assert rows(log.events().where("dag_id = 'bad'").select("status", "message")) == [("ERROR", "why"), ("RUNNING", "")]


def test_log_scan_has_file_and_place(spark, files):
    path = files(**{"x.log": "a\nerror b\n"})
    found = a.log_highlights(a.scan_logs(spark, path), order_by=["block", "position"])
    assert rows(found.where("section = 'highlight'").select("source", "from_end", "line")) == [("x.log", 1, "error b")]
