from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakestrata import constants as const
from lakestrata.operators import quality as q
from lakestrata.plans.batch import Medallion
from lakestrata.plans.cleaning import clean_job, daily_gold_job
from lakestrata.plans.live import examine, gold_live, medallion_live
from lakestrata.sources import files as f
from lakestrata.sources import tabular
from lakestrata.sources.synthetic import generate_orders
from registry.writing import json_array_lines, write_named_files
from tests.conftest import plan, rows

HEADER = "order_id,customer_id,product_name,unit_price,quantity,order_date\n"


def _sample_orders():
    """A header, prose, a blank line, a stray word, the header again, then 110 rows of 68 orders."""
    lines = [f"{1000 + i % 68},{900 + i % 68},Phone,{100 + i % 68},1,2026-01-{1 + i % 28:02d}" for i in range(68)]
    lines += lines[:42]
    return HEADER + "Here is the dataset, with headers:\n\ntext\n" + HEADER + "\n".join(lines)


def layouts(spark, path, **options):
    listed = f.list_files(spark, path)
    return f.sniff_layout(f.csv_heads(listed), **options).join(listed.select("path", "file_name"), "path")


def test_listing_takes_regular_files_only(spark, files):
    path = files.write({"a.CSV": "id\n1\n", "b.txt": "x", "c": "x", "e.csv": "", "a b+1%[x].json": "{}"})
    write_named_files(spark.createDataFrame([("old.csv", 0, "x")], "file_name string, seq int, line string"), f"{path}/processed")
    got = rows(f.list_files(spark, path).select("file_name", "extension", "supported"))
    assert got == sorted([("a.CSV", ".csv", True), ("b.txt", ".txt", False), ("c", "", False), ("e.csv", ".csv", True),
                          ("a b+1%[x].json", ".json", True)], key=repr)
    only_csv = f.list_files(spark, path, [".csv"])
    assert rows(f.unsupported_files(only_csv).select("file_name")) == sorted([("b.txt",), ("c",), ("a b+1%[x].json",)], key=repr)


def test_sample_file(spark, files):
    path = files(**{"orders.csv": _sample_orders()})
    lay = layouts(spark, path)
    df = tabular.scan_csv_files(spark, lay)
    assert df.columns[:6] == ["order_id", "customer_id", "product", "unit_price", "quantity", "order_date"]
    assert df.count() == 113
    assert df.where(F.col("order_id").try_cast("bigint").isNotNull()).count() == 110
    view = medallion_live(spark, path)
    assert (view.bronze.count(), view.silver.count()) == (113, 71)
    assert view.bronze.where("order_id = 'order_id' AND product = 'product_name'").count() == 1


def test_header_words_are_matched_inside_cells(spark, files):
    path = files(**{"a.csv": "X,ORDERS_total\n1,2\n", "b.csv": "7,Candid\n8,x\n", "c.csv": "7,8\n9,9\n"})
    got = rows(layouts(spark, path).select("file_name", "has_header"))
    assert got == [("a.csv", True), ("b.csv", True), ("c.csv", False)]


def test_first_records(spark, files):
    path = files.write({
        "a.csv": "\n\nid,date\n1,2\n", "b.csv": "\ufeffid,\"x, y\"\n1,2\n".encode(), "c.csv": "1,2", "d.csv": "order_id,revenue\n"})
    heads = f.csv_heads(f.list_files(spark, path)).select("path", "first_record", "has_more")
    assert [r[1:] for r in rows(heads)] == [
        (["id", "date"], True), (["id", "x, y"], True), (["1", "2"], False), (["order_id", "revenue"], False)]


def test_bad_bytes_are_found_anywhere_and_wide_cells_are_read(spark, files):
    good = "".join(f"{i},2026-01-01,p\n" for i in range(3000)).encode()
    path = files.write({
        "early.csv": b"id,date,product\n1,2026-01-01,caf\xe9\n" + good, "late.csv": b"id,date,product\n" + good + b"1,2026-01-01,caf\xe9\n",
        "wide.csv": b"id,date,product\n1,2026-01-01," + b"w" * 200_000 + b"\n"})
    view = medallion_live(spark, path)
    assert rows(view.issues.select("source_file", "order_id")) == [("early.csv", "PARSE_ERROR"), ("late.csv", "PARSE_ERROR")]
    assert [len(r[0]) for r in rows(view.bronze.select("product"))] == [200_000]


def test_names_with_an_underscore_get_a_disposition(spark, files, folder):
    path = files.write({"_orders.csv": HEADER, "_SUCCESS": "", ".hidden.csv": "x"})
    Medallion(spark, folder).run(path)
    got = rows(f.read_manifest(spark, f"{folder}/manifest").select("disposition", "reason"))
    assert len(got) == 1 and got[0][0] == "rejected" and f.HIDDEN_NAME in got[0][1]


def test_names_for_files_without_header(spark, files):
    path = files(**{"n.csv": "7,2026-01-01\n8,2026-01-02\n", "w.csv": "7,2026-01-01,P,5,x,y\n"})
    cut = tabular.scan_csv_files(spark, layouts(spark, path))
    assert cut.columns[:4] == const.HEADERLESS_NARROW
    assert rows(cut.select("order_id", "order_date", "product", "revenue")) == [
        ("7", "2026-01-01", "P", "5"), ("7", "2026-01-01", None, None), ("8", "2026-01-02", None, None)]
    named = layouts(spark, path, name_extra=True)
    got = {r["file_name"]: r["columns"] for r in named.collect()}
    assert got == {"n.csv": ["order_id", "order_date"], "w.csv": [*const.HEADERLESS_NARROW, "extra_col_1", "extra_col_2"]}


def test_ragged_rows(spark, files):
    path = files(**{"r.csv": "id,date,x\n1,2026-01-01\n2,2026-01-02,a\n3,2026-01-03,b,c\n"})
    lay = layouts(spark, path)
    pad = tabular.scan_csv_files(spark, lay).select("order_id", "x")
    skip = tabular.scan_csv_files(spark, lay, ragged="skip").select("order_id", "x")
    assert rows(pad) == [("1", None), ("2", "a"), ("3", "b")]
    assert rows(skip) == [("1", None), ("2", "a")]


def test_quotes_marks_and_repeated_names(spark, files):
    path = files.write({"q.csv": "﻿ID,Product,id,order_date\n1,\"a, \"\"b\"\"\",9,2026-01-01\n".encode()})
    df = tabular.scan_csv_files(spark, layouts(spark, path))
    assert rows(df.select("order_id", "product", "order_date")) == [("1", 'a, "b"', "2026-01-01")]
    assert df.columns.count("order_id") == 1


def test_every_file_issue(spark, files):
    path = files.write({
        "good.csv": "id,date\n1,2026-01-01\n", "u.xlsx": "x", "noext": "x", "bad.json": '[{"order_id": "1", "order_',
        "empty.csv": "", "empty.json": "", "one.csv": "7\n8\n", "schema.csv": "order_id,revenue\n1,2\n",
        "headonly.csv": "order_id,revenue\n", "schema.json": '[{"x": 1}]', "latin.csv": "id,date\n1,é\n".encode("latin-1"),
        "good.json": '{"id": 5, "event_timestamp": "2026-01-01"}'})
    examined, _ = examine(f.list_files(spark, path))
    got = {r["source_file"]: (r["order_id"], r["Reason"].split(":")[0]) for r in f.file_issues(examined).collect()}
    assert got == {
        "u.xlsx": ("N/A", "Unsupported File Format"), "noext": ("N/A", "Unsupported File Format"),
        "bad.json": ("CRITICAL", "Corrupted JSON"), "empty.json": ("CRITICAL", "Corrupted JSON"),
        "empty.csv": ("EMPTY", "Corrupted Data"), "one.csv": ("PARSE_ERROR", "Corrupted CSV"),
        "schema.csv": ("SCHEMA_ERROR", "Validation Failed"), "schema.json": ("SCHEMA_ERROR", "Validation Failed"),
        "latin.csv": ("PARSE_ERROR", "Corrupted CSV")}
    assert f.file_issues(examined).columns == ["order_id", "source_file", "Reason", "order_date", "product"]


def test_file_that_vanishes_is_an_access_error(spark, files):
    path = files(**{"a.csv": "id,date\n1,2\n"})
    listed = f.list_files(spark, path).withColumn("path", F.concat("path", F.lit(".gone.csv")))
    assert f.file_issues(f.examine_files(listed)).first()["order_id"] == "IO_ERROR"


def test_json_forms(spark, files):
    path = files(**{
        "array.json": '[\n  {"order_id": "J100", "order_date": "2024-03-14", "product": "W", "revenue": 150},\n'
                      '  {"order_id": "J101", "order_date": "2024-03-14", "product": "C", "revenue": 99}\n]\n',
        "object.json": '{"order_id": "J102", "order_date": "2024-03-15"}', "broken.json": '[{"order_id": "J1"'})
    assert rows(tabular.scan_json(spark, path)) == [
        ("J100", "2024-03-14", "W", 150.0), ("J101", "2024-03-14", "C", 99.0), ("J102", "2024-03-15", None, None)]


def test_evolution_is_by_name_whatever_the_column_order(spark, files):
    path = files(**{"a.csv": "order_date,order_id\n2026-01-01,1\n", "b.csv": "order_id,order_date,discount_code\n2,2026-01-02,SUMMER20\n"})
    df = tabular.scan_csv_files(spark, layouts(spark, path)).select("order_id", "order_date", "discount_code")
    assert rows(df) == [("1", "2026-01-01", None), ("2", "2026-01-02", "SUMMER20")]
    assert rows(tabular.scan_csv_declared(spark, layouts(spark, path)).select("order_id", "revenue")) == [("1", None), ("2", None)]


def test_json_extra_fields_and_mixed_case(spark, files):
    path = files(**{"a.json": '[{" Order_ID ": 1, "Date": "2026-01-01", "Extra": "e"}]', "b.csv": "id,date\n2,2026-01-02\n"})
    view = medallion_live(spark, path)
    assert rows(view.bronze.select("order_id", "order_date", "extra")) == [("1", "2026-01-01", "e"), ("2", "2026-01-02", None)]
    assert view.issues.count() == 0


def test_nothing_readable(spark, files):
    view = medallion_live(spark, files(**{"a.txt": "x"}))
    assert view.bronze is None and view.issues.count() == 1


def test_odd_file_names_are_read_literally(spark, files):
    path = files.write({"a b+1%[x].csv": "id,date\n1,2026-01-01\n", "a b+1%x.csv": "id,date\n2,2026-01-01\n"})
    view = medallion_live(spark, path)
    assert rows(view.bronze.select("order_id", "source_file")) == [("1", "a b+1%[x].csv"), ("2", "a b+1%x.csv")]


def test_live_silver_keeps_the_first_row_in_file_order(spark, files):
    path = files(**{"b.csv": "id,date,product\n1,2026-01-01,late\n", "a.csv": "id,date,product\n1,2026-01-01,first\n1,2026-01-01,second\n"})
    view = medallion_live(spark, path)
    assert rows(view.silver.select("product")) == [("first",)]
    checks = q.live_checks(view.issues, view.bronze, view.silver, as_of="2026-03-01")
    assert checks.where("layer = 'silver' AND name = 'Deduplication Applied'").count() == 1


def test_gold_live_maps_columns_per_layout(spark, files):
    path = files(**{
        "a.csv": "OrderID,amount,when_sold\n1,5,2026-01-01\n2,5,bad\n", "b.csv": "Order ID,Date\n1,2026-01-03 10:00:00\n",
        "c.json": '[{"id": "9", "timestamp": "2026-01-01"}]'})
    gold = gold_live(spark, path)
    assert rows(gold.select(F.col("date").cast("string"), "total_orders", "last_processed")) == [
        ("2026-01-01", 1, "2026-01-01 00:00:00"), ("2026-01-03", 1, "2026-01-03 10:00:00")]


def test_batch_run_in_steps(spark, files, folder):
    path = files(**{
        "a.csv": HEADER + "1,9,P,5,1,2026-01-01\n1,9,P,5,2,2026-01-01\n,9,P,5,1,2026-01-01\n2,9,P,5,0,2026-01-01\n",
        "head.csv": HEADER, "n.txt": "x"})
    made = generate_orders(spark, 1000, 200)
    name = F.lit("made.json")
    write_named_files(json_array_lines(made.withColumn("n", F.monotonically_increasing_id()), name, made.columns, ["n"]), path)
    m = Medallion(spark, folder)
    m.run(path)
    assert rows(m.silver.read().select("order_id", "quantity")) == [("1", 1)]
    assert rows(m.quarantine.read().select("rejection_reason")) == [("non_positive_quantity",), ("null_order_id",)]
    first = {r["path"].rsplit("/", 1)[1]: (r["disposition"], r["reason"]) for r in f.read_manifest(spark, m.manifest).collect()}
    assert first["made.json"] == ("rejected", "duplicate_ratio") and first["head.csv"] == ("rejected", "empty")
    assert first["a.csv"] == ("processed", None) and first["n.txt"][0] == "unsupported"

    files(**{"b.csv": HEADER + "1,9,P,5,7,2026-02-01\n3,9,P,,1,2026-02-01\n"})
    assert m.run(path).count() == 1
    assert rows(m.silver.read().select("order_id", "quantity", "unit_price")) == [("1", 1, 5.0), ("3", 1, None)]
    assert m.silver.runs().count() == 2 and m.quarantine.runs().count() == 1
    assert m.run(path).count() == 0
    assert f.read_manifest(spark, m.manifest).count() == 5


@pytest.mark.parametrize("table", ["bronze", "quarantine", "validated", "silver", "gold", "manifest"])
def test_run_that_died_has_changed_nothing(spark, files, folder, monkeypatch, table):
    path = files(**{"a.csv": HEADER + "1,9,P,5,1,2026-01-01\n,9,P,5,1,2026-01-01\n"})
    Medallion(spark, folder).run(path)
    files(**{"b.csv": HEADER + "2,9,P,5,1,2026-01-01\n,9,P,5,1,2026-01-01\n5,9,P,5,1,2026-01-07\n"})
    m = Medallion(spark, folder)

    def content(m):
        return (rows(m.silver.read().select("order_id")), m.bronze.read().count(), m.quarantine.read().count(),
                m.validated.read().count(), rows(m.gold.read().select(F.col("order_date").cast("string"), "total_orders_per_day")))

    before = content(m)
    with monkeypatch.context() as patch:
        if table == "manifest":
            patch.setattr(f, "record_dispositions", lambda *a: 1 / 0)
        else:  # the layer is written, and then the run dies
            write = getattr(getattr(m, table), "apply" if table == "gold" else "write")
            patch.setattr(getattr(m, table), "apply" if table == "gold" else "write", lambda *a: (write(*a), 1 / 0))
        with pytest.raises(ZeroDivisionError):
            m.run(path)
    again = Medallion(spark, folder)
    assert content(again) == before == ([("1",)], 2, 1, 1, [("2026-01-01", 1)])
    (Path(path) / "b.csv").unlink()  # what the dead run touched need not be touched again
    files(**{"c.csv": HEADER + "3,9,P,5,1,2026-01-01\n"})
    assert again.run(path).count() == 1
    assert content(again) == ([("1",), ("3",)], 3, 1, 2, [("2026-01-01", 2)])
    assert len(again.vacuum()) == 1 and again.vacuum() == []
    assert content(again) == ([("1",), ("3",)], 3, 1, 2, [("2026-01-01", 2)])
    assert again.run(path).count() == 0


def test_file_delivered_again_under_its_name(spark, files, folder):
    path = files(**{"orders.csv": HEADER + "1,9,P,5,1,2026-01-01\n"})
    m = Medallion(spark, folder)
    m.run(path)
    files(**{"orders.csv": HEADER + "1,9,P,5,1,2026-01-01\n2,9,P,5,1,2026-01-01\n3,9,P,5,1,2026-01-01\n"})
    assert m.run(path).count() == 1
    assert rows(m.silver.read().select("order_id")) == [("1",), ("2",), ("3",)]


def test_rows_are_judged_before_they_are_cast(spark, files, folder):
    quantities = ["5.0", "-2.0", "0.0", "abc", "1.5", "7", ""]
    path = files(**{"a.csv": HEADER + "".join(f"{i},9,P,5,{q},2026-01-01\n" for i, q in enumerate(quantities)),
                    "b.csv": HEADER + "".join(f"x{i},9,P,5,{i}.5,2026-01-01\n" for i in range(4))})
    m = Medallion(spark, folder)
    m.run(path)
    assert rows(m.silver.read().select("order_id", "quantity")) == [("0", 5), ("5", 7), ("6", None)]
    got = rows(m.quarantine.read().where("order_id NOT LIKE 'x%'").select("order_id", "quantity", "rejection_reason"))
    assert got == [("1", "-2.0", "non_positive_quantity"), ("2", "0.0", "non_positive_quantity"),
                   ("3", "abc", "invalid_quantity"), ("4", "1.5", "invalid_quantity")]
    assert m.quarantine.read().where("order_id LIKE 'x%'").count() == 4  # different rows, not copies


def test_json_lines_documents_and_what_is_neither(spark, files):
    path = files(**{
        "lines.json": "".join('{"id": %d, "date": "2026-01-01"}\n' % i for i in range(10)), "empty.json": "[]",
        "nulls.json": '[{"id": null, "date": null}]', "trailing.json": '[{"id": 1, "date": "2026-01-01"}] x',
        "cut.json": '{"id": 1, "date": "2026-01-01"}\n{"id": 2,\n', "pretty.json": '{\n "id": 77,\n "date": "2026-01-01", "n": 1.50\n}\n'})
    view = medallion_live(spark, path)
    assert view.bronze.where("source_file = 'lines.json'").count() == 10
    assert rows(view.bronze.where("source_file = 'pretty.json'").select("order_id", "n")) == [("77", "1.50")]
    assert rows(view.issues.select("source_file", "order_id")) == [("cut.json", "CRITICAL"), ("trailing.json", "CRITICAL")]
    assert view.bronze.where("source_file = 'nulls.json'").count() == 1
    assert tabular.scan_json(spark, path).count() == 12


def test_line_breaks_in_cells_are_found(spark, files, folder):
    path = files(**{"a.csv": HEADER + '1,9,"two\nlines",5,1,2026-01-01\n2,9,P,5,1,2026-01-01\n'})
    m = Medallion(spark, folder)
    m.run(path)
    assert rows(m.bronze.read().select("order_id", "product")) == [("1", "two\nlines"), ("2", "P")]


def test_ratio_at_the_limit_passes(spark, files, folder):
    path = files(**{"a.csv": "order_id,order_date\n1,2026-01-01\n1,2026-01-01\n"})
    m = Medallion(spark, folder)
    m.run(path)
    assert rows(f.read_manifest(spark, m.manifest).select("disposition")) == [("processed",)]


def test_cleaning_jobs(spark, files, folder):
    path = files(**{"raw.csv": "id,age,order_date,revenue\n1,28,2026-01-01,2.5\n1,28,2026-01-01,2.5\n2,29,2026-01-01,1\n3,,bad,1\n"})
    out = clean_job(spark, path, folder)
    assert rows(out.select("id", "age")) == [(1, 28), (2, 29), (3, 28)]
    assert out.where("processed_time IS NULL").count() == 0
    assert rows(daily_gold_job(spark, path).selectExpr("cast(order_date as string)", "total_orders_per_day", "total_revenue_per_day")) == [
        ("2026-01-01", 2, 3.5)]
    bare = files(**{"raw.csv": "id\n1\n2\n"})
    assert rows(daily_gold_job(spark, bare).selectExpr("order_date = current_date()", "total_orders_per_day", "total_revenue_per_day")) == [(True, 2, 0.0)]


@pytest.mark.parametrize("ragged", ["pad", "skip"])
def test_layout_scans_need_no_join(spark, files, ragged):
    path = files(**{"a.csv": "id,date\n1,2\n", "b.csv": "date,id\n1,2\n", "c.csv": "id,date\n3,4\n"})
    text = plan(tabular.scan_csv_files(spark, layouts(spark, path), ragged))
    assert "Join" not in text and "Exchange" not in text and text.count("Scan csv") == 2


def test_json_files_without_any_usable_field(spark, files):
    path = files(**{"a.json": "[", "b.json": "[{"})
    assert rows(medallion_live(spark, path).issues.select("order_id", "source_file")) == [("CRITICAL", "a.json"), ("CRITICAL", "b.json")]
    files(**{"b.json": '[{"x": 1}]'})
    assert rows(medallion_live(spark, path).issues.select("order_id", "source_file")) == [("CRITICAL", "a.json"), ("SCHEMA_ERROR", "b.json")]


def test_line_breaks_inside_quoted_cells(spark, files):
    path = files(**{"a.csv": 'id,date,product\n1,2026-01-01,"two\nlines"\n2,2026-01-01,x\n'})
    view = medallion_live(spark, path, multi_line=True)
    assert rows(view.bronze.select("order_id", "product")) == [("1", "two\nlines"), ("2", "x")]


def test_work_tables_are_deleted_also_after_a_failure(spark, files, folder, monkeypatch):
    from lakestrata.session import Workspace
    from lakestrata.sources.storage import file_info
    used, make = [], Workspace.__init__
    monkeypatch.setattr(Workspace, "__init__", lambda self, *a: (make(self, *a), used.append(self.folder))[0])
    path = files(**{"a.csv": HEADER + "1,9,P,5,1,2026-01-01\n"})
    m = Medallion(spark, folder)
    monkeypatch.setattr(m.silver, "write", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        m.run(path)
    Medallion(spark, folder).run(path)
    assert len(used) == 3 and all(file_info(spark, place) is None for place in used)
    assert Medallion(spark, folder).silver.read().count() == 1
