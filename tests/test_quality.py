import json

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import quality as q
from lakestrata.operators.dedup import dedup_by_key
from lakestrata.operators.gold import gold_daily
from lakestrata.plans.report import check_layers, layer_report
from lakestrata.sources import sinks
from lakestrata.sources.versioned import VersionedTable
from registry.writing import write_named_files

AS_OF = "2026-03-13"


@pytest.fixture(scope="module")
def bronze(spark):
    """417 rows, 316 ids, future dates on 64 days: the numbers of a known report."""
    return spark.range(417).selectExpr(
        "id % 316 + 181 AS order_id", "id % 316 + 81 AS customer_id", "'Phone' AS product",
        "CAST(21 + id % 316 AS double) AS unit_price", "1 + id % 316 % 4 AS quantity",
        "CAST(date_add(DATE '2026-03-28', CAST(id % 316 % 64 AS int)) AS string) AS order_date",
        "CAST(null AS string) AS discount_code", "current_timestamp() AS ingestion_timestamp",
        "'orders_batch1.csv' AS source_file")


def _checks(df):
    return {x["name"]: (x["status"], x["message"]) for x in df.collect()}


def test_known_bronze_report(spark, bronze):
    assert _checks(q.batch_checks(bronze, "bronze", AS_OF)) == {
        "row_count": ("PASS", "417 rows"),
        "null_check_order_id": ("PASS", "No nulls in order_id"),
        "null_check_order_date": ("PASS", "No nulls in order_date"),
        "null_check_customer_id": ("PASS", "No nulls in customer_id"),
        "duplicate_order_ids": ("WARNING", "101 duplicate order_id(s) (24.22%) — expected in Bronze"),
        "range_unit_price": ("PASS", "All unit_price values > 0"),
        "range_quantity": ("PASS", "All quantity values > 0"),
        "date_validity": ("PASS", "All order_date values parse as valid dates"),
        "future_dates": ("WARNING", "417 row(s) with future order_date"),
        "schema_check": ("PASS", "All required columns present")}


def test_known_silver_and_gold_reports(spark, bronze):
    silver = dedup_by_key(bronze).withColumn("processing_timestamp", F.current_timestamp())
    checks = _checks(q.batch_checks(silver, "silver", AS_OF))
    assert checks["duplicate_order_ids"] == ("PASS", "No duplicate order_ids")
    assert checks["silver_row_sanity"] == ("PASS", "Silver has 316 rows (duplicates removed from validated)")
    gold = _checks(q.batch_checks(gold_daily(silver), "gold", AS_OF))
    assert list(gold) == ["row_count", "null_check_order_date", "date_validity", "future_dates", "schema_check"]
    assert gold["row_count"] == ("PASS", "64 rows")
    assert gold["future_dates"] == ("WARNING", "64 row(s) with future order_date")


def test_severities(spark):
    rows = [(None, "2026-01-01", 1, 1.0)] * 2 + [("7", "bad", 0, -1.0)] * 2 + [("8", "2026-01-01", 1, 1.0)] * 16
    df = spark.createDataFrame(rows, "order_id string, order_date string, quantity int, unit_price double")
    checks = _checks(q.batch_checks(df, "gold", AS_OF))
    assert checks["null_check_order_id"] == ("CRITICAL", "2 nulls in order_id (10.0%) — exceeds 5% threshold")
    assert checks["duplicate_order_ids"] == ("CRITICAL", "17 duplicate order_id(s) (85.0%) — unexpected at this layer")
    assert checks["range_quantity"] == ("WARNING", "2 row(s) with quantity <= 0")
    assert checks["date_validity"] == ("CRITICAL", "2 row(s) with unparseable order_date")
    assert checks["schema_check"] == ("CRITICAL", "Missing required columns: ['total_orders_per_day']")


def test_five_percent_is_a_warning_still(spark):
    df = spark.range(20).selectExpr("if(id = 0, null, id) AS order_id")
    assert _checks(q.batch_checks(df, "x"))["null_check_order_id"] == ("WARNING", "1 nulls in order_id (5.0%)")


def test_reason_checks(spark):
    df = spark.createDataFrame([("1", None), ("2", ""), ("3", "why")], "order_id string, rejection_reason string")
    assert _checks(q.batch_checks(df, "quarantine"))["rejection_reason_completeness"] == (
        "CRITICAL", "2 quarantine records missing rejection reason")
    assert _checks(q.batch_checks(df, "validated"))["clean_validation"] == (
        "CRITICAL", "1 validated records still have rejection reasons")
    assert "clean_validation" not in _checks(q.batch_checks(df.drop("rejection_reason"), "validated"))


def test_empty_layer(spark):
    df = spark.createDataFrame([], "order_id string, order_date string, processing_timestamp timestamp")
    checks = _checks(q.batch_checks(df, "silver"))
    assert checks["row_count"] == ("CRITICAL", "Table is empty (0 rows)")
    assert checks["null_check_order_id"][0] == "PASS" and "silver_row_sanity" not in checks


def test_report_over_stored_layers(spark, bronze, folder):
    sinks.write_parquet(bronze, f"{folder}/bronze")
    VersionedTable(spark, f"{folder}/silver").append(
        dedup_by_key(bronze).withColumn("processing_timestamp", F.current_timestamp()))
    write_named_files(spark.createDataFrame(
        [("x.parquet", 0, "not parquet")], "file_name string, seq int, line string"), f"{folder}/quarantine")
    report = layer_report(spark, folder, AS_OF)
    sinks.write_report(report, f"{folder}/report")
    read = spark.read.schema(report.schema).json(f"{folder}/report").first()
    layers = {x["layer"]: x for x in read["layers"]}
    assert [x["layer"] for x in read["layers"]] == ["bronze", "quarantine", "validated", "silver", "gold"]
    assert read["overall_status"] == "FAIL" and read["generated_at"] is not None
    assert (layers["bronze"]["status"], layers["bronze"]["row_count"], layers["bronze"]["warnings"]) == ("WARN", 417, 2)
    assert layers["silver"]["row_count"] == 316 and layers["silver"]["columns"][-1] == "processing_timestamp"
    assert layers["quarantine"]["checks"][0]["name"] == "delta_read"
    assert len(layers["quarantine"]["checks"][0]["message"]) <= 200 + len("Cannot read Delta table: ")
    assert layers["gold"]["checks"][0]["message"] == f"Path does not exist: {folder}/gold"
    text = json.loads(sinks.report_json(report).first()["report"])
    assert set(text) == {"generated_at", "overall_status", "layers"}


def test_rollup_levels(spark):
    rows = [("a", 1, "n", "PASS", "m", 5), ("b", 1, "n", "WARNING", "m", 6), ("c", 1, "n", "CRITICAL", "m", 0),
            ("c", 2, "n", "CRITICAL", "m", 0)]
    checks = spark.createDataFrame(rows, q.CHECK_SCHEMA)
    got = {x["layer"]: (x["status"], x["critical_failures"]) for x in q.rollup(checks).collect()}
    assert got == {"a": ("PASS", 0), "b": ("WARN", 0), "c": ("FAIL", 2)}
    live = {x["layer"]: x["critical_failures"] for x in q.rollup(checks, empty_counts_once=True).collect()}
    assert live["c"] == 1
    totals = q.report_totals(q.rollup(checks)).first()
    assert (totals["rows_checked"], totals["checks_run"], totals["passing"], totals["issues"], totals["overall_status"]) == (11, 4, 1, 3, "FAIL")


def test_live_checks(spark):
    schema = "order_id string, order_date string, quantity string, pos int"
    bronze = spark.createDataFrame(
        [("1", "2026-01-01", "-1", 0), ("1", "2026-01-01", "x", 1), (None, "", "2", 2), (None, "2999-01-01", "2", 3)], schema)
    silver = bronze.where("pos in (0, 2, 3)")
    issues = spark.createDataFrame([("Corrupted CSV: x",), ("Unsupported y",)], "Reason string")
    got = {(x["layer"], x["name"]): (x["status"], x["message"]) for x in q.live_checks(issues, bronze, silver, ["pos"], "2026-03-14").collect()}
    assert got[("input", "File Formats")] == ("WARNING", "1 file(s) follow unsupported formats.")
    assert got[("input", "Data Integrity")] == ("CRITICAL", "1 corrupted file(s) found in input folder.")
    assert got[("bronze", "Row Count")] == ("PASS", "4 rows found.")
    assert got[("bronze", "No Duplicate Order IDs")] == ("WARNING", "4 duplicate rows for IDs: 1, None")
    assert got[("bronze", "No Null Critical Fields")] == ("CRITICAL", "order_id: 2 null/empty | order_date: 1 null/empty")
    assert got[("bronze", "No Negative Numeric Values")] == ("WARNING", "quantity: 1 negative value(s)")
    assert got[("bronze", "Valid Date Format")] == ("WARNING", "1 row(s) have unparsable dates.")
    assert got[("bronze", "No Future Dates")] == ("WARNING", "1 row(s) have dates set in the future.")
    assert got[("silver", "Deduplication Applied")] == (
        "PASS", "1 duplicate row(s) removed (25.0% of Bronze). 3 unique records remain.")


def test_live_checks_of_an_empty_layer(spark):
    empty = spark.createDataFrame([], "order_id string")
    got = [tuple(x) for x in q.live_layer_checks(empty, "bronze").select("name", "status", "message").collect()]
    assert got == [("Row Count", "CRITICAL", "Table is empty — no data loaded."),
                   ("Required Columns Present", "CRITICAL", "Missing columns: order_date")]


def test_more_than_five_samples(spark):
    df = spark.range(20).selectExpr("CAST(id % 8 AS string) AS order_id", "id AS pos")
    got = q.duplicate_members(df, order_by=["pos"]).first()
    assert (got["sample_ids"], got["suffix"]) == ("0, 1, 2, 3, 4", " … and 3 more")


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (2, "b")], "x int, y string")
    got = [tuple(r) for r in q.column_profile(df).orderBy("position").collect()]
    assert got == [(0, "x", 4, 1, 2, 25.0, 50.0), (1, "y", 4, 1, 2, 25.0, 50.0)]
    assert "Expand" not in q.column_profile(df)._jdf.queryExecution().executedPlan().toString()


def test_layers_are_reported_in_the_given_order(spark, folder):
    layers = check_layers(spark, {"z": f"{folder}/z", "a": f"{folder}/a"})
    assert [x["layer"] for x in q.quality_report(layers).first()["layers"]] == ["z", "a"]
