from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestrata.functions import predicates as p
from lakestrata.operators import rules as r
from tests.conftest import rows

VALUES = [None, "", "  ", "nan", "abc", "invalid-date", "2026-01-05", "2026-01-05 10:00:00", "2999-01-01", "-3", "0", "2.5", "01/05/2026"]


def test_predicates_on_awkward_values(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "x string")
    def hits(test):
        return [r[0] for r in df.where(test).collect()]
    assert hits(p.is_blank("x")) == [None, "", "  "]
    assert hits(p.is_missing_text("x")) == [None, "", "nan"]
    assert hits(p.is_not_positive("x")) == ["-3", "0"]
    assert hits(p.is_negative("x")) == ["-3"]
    assert set(hits(~p.is_bad_day("x"))) == {"2026-01-05", "2026-01-05 10:00:00", "2999-01-01"}
    assert hits(p.is_after_day("x", "2026-01-04")) == ["2026-01-05", "2026-01-05 10:00:00", "2999-01-01"]
    assert hits(p.is_after_next_day("x", "2026-01-04")) == ["2026-01-05 10:00:00", "2999-01-01"]
    assert hits(p.mentions("x", "date")) == ["invalid-date"]


def test_numeric_date_and_timestamp_columns_are_accepted(spark):
    df = spark.sql("SELECT 5 AS n, DATE '2026-01-05' AS d, TIMESTAMP '2026-01-05 10:00:00' AS t")
    out = df.select(p.is_negative("n"), p.is_bad_day("d"), p.is_bad_moment("t"), p.is_after_day("t", "2026-01-04"))
    assert tuple(out.first()) == (False, False, False, True)


def test_one_reason_in_order(spark):
    bad = [(999, None, -50.0, 0, "invalid-date"), (None, None, -1.0, 0, None), (1, 2, -1.0, 1, "2026-01-01"),
           (1, None, 5.0, 1, "2026-01-01"), (1, 1, 5.0, 1, "x"), (1, 1, 5.0, 1, " ")]
    df = spark.createDataFrame(bad, "order_id int, customer_id int, unit_price double, quantity int, order_date string")
    reasons = [x["rejection_reason"] for x in r.with_rejection_reason(df).collect()]
    assert reasons == ["non_positive_quantity", "null_order_id", "non_positive_unit_price", None, "invalid_order_date", "null_order_date"]
    clean, quarantined = r.split_quarantine(df)
    assert clean.count() == 1 and quarantined.count() == 5 and "rejection_reason" not in clean.columns


def test_rules_on_absent_columns_do_not_apply(spark):
    df = spark.createDataFrame([(1,)], ["other"])
    assert r.with_rejection_reason(df).first()["rejection_reason"] is None


RATIO_ROWS = st.lists(st.tuples(
    st.sampled_from(["a", "b"]), st.sampled_from([None, "x", "y"]), st.sampled_from([None, "x", "y"])), max_size=20)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(RATIO_ROWS)
def test_file_gate_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "source_file string, order_id string, order_date string")
    want = {}
    for name in {row[0] for row in data}:
        part = [row for row in data if row[0] == name]
        dup = (len(part) - len(set(part))) / len(part)
        null = sum(1 for row in part if None in row[1:]) / len(part)
        reason = "duplicate_ratio" if dup > 0.5 else "null_ratio" if null > 0.5 else None
        want[name] = (len(part), round(dup, 9), round(null, 9), reason)
    got = {x["source_file"]: (x["total_rows"], round(x["dup_ratio"], 9), round(x["null_ratio"], 9), x["reason"])
           for x in r.file_threshold_gate(df).collect()}
    assert got == want


def test_empty_input_has_zero_ratios(spark):
    df = spark.createDataFrame([], "order_id string, order_date string")
    assert tuple(r.quality_ratios(df).first()) == (0, 0.0, 0.0)


def test_generated_file_with_many_repeats_is_rejected(spark):
    from lakestrata.sources.synthetic import generate_orders
    made = generate_orders(spark, 1000, 200, seed=3)
    assert made.count() == 1000 and made.distinct().count() <= 200
    assert made.where(~F.col("revenue").between(50, 500)).count() == 0
    verdict = r.file_threshold_gate(made.withColumn("source_file", F.lit("v.json"))).first()
    assert verdict["dup_ratio"] >= 0.8 and verdict["reason"] == "duplicate_ratio"
    assert rows(made) == rows(generate_orders(spark, 1000, 200, seed=3))
    assert rows(made) != rows(generate_orders(spark, 1000, 200, seed=4))


def test_validation_frame_lists_every_reason(spark):
    df = spark.createDataFrame(
        [("1", "2026-01-01", -1, "p", "f", 0), ("1", "2026-01-01", 2, "p", "f", 1), ("", None, -5, "p", "f", 2),
         ("3", "2999-01-01", 1, "p", "f", 3)],
        "order_id string, order_date string, quantity int, product string, source_file string, pos int")
    issues = spark.createDataFrame(
        [("N/A", "a.txt", "Unsupported File Format", "N/A", "N/A")],
        "order_id string, source_file string, Reason string, order_date string, product string")
    out = r.validation_frame(df, issues, ["pos"], "2026-03-14")
    assert out.columns == ["order_id", "Occurrences", "source_file", "product", "order_date", "Reason"]
    got = rows(out.select("order_id", "Occurrences", "Reason"))
    assert got == sorted([
        ("N/A", 1, "Unsupported File Format"),
        ("1", 2, "Duplicate Error: Found 2 entries for this ID. 1 will be filtered."),
        ("", 1, "Validation Failed: order_id is missing or null"),
        ("", 1, "Validation Failed: order_date is missing or null"),
        ("1", 1, "Quality Alert: Negative value detected in quantity"),
        ("", 1, "Quality Alert: Negative value detected in quantity"),
        ("3", 1, "Temporal Error: Record date is set in the future")], key=repr)


def test_default_date_range(spark):
    def bounds(*days):
        df = spark.createDataFrame([(d,) for d in days], "d string").selectExpr("cast(d as date) AS date")
        return tuple(str(x) for x in r.default_date_range(df).first())
    assert bounds("2025-06-01", "2026-03-01") == ("2026-01-01", "2026-03-01")
    assert bounds("2026-02-01", "2027-03-01") == ("2026-02-01", "2026-12-31")
    assert bounds("2024-02-01", "2025-03-01") == ("2024-02-01", "2025-03-01")


def test_breakdown_and_summary(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "rejection_reason string")
    assert [tuple(x) for x in r.rejection_breakdown(df).collect()] == [("a", 2), ("b", 1)]
    issues = spark.createDataFrame([("Unsupported x",), ("Corrupted y",), (None,)], "Reason string")
    assert tuple(r.issue_summary(issues, ["Unsupported", "Corrupted", "Duplicate"]).first()) == (3, 1, 1, 0)
