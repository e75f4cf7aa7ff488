import sys

import lakestrata.__main__ as cli
from lakestrata.plans.batch import Medallion

HEADER = "order_id,order_date\n"


def _run(monkeypatch, *arguments):
    monkeypatch.setattr(sys, "argv", ["lakestrata", *arguments])
    return cli.main()


def test_jobs(spark, files, folder, monkeypatch, capsys):
    path = files(**{"a.csv": HEADER + "1,2026-01-01\n,2026-01-01\n"})
    assert _run(monkeypatch, "medallion", path, folder) == 0
    assert Medallion(spark, folder).silver.read().count() == 1
    # the run has written every layer: one row is in quarantine, nothing fails
    assert _run(monkeypatch, "quality", folder, f"{folder}/report", "--as-of", "2026-03-14") == 1
    out = capsys.readouterr().out
    assert "Path does not exist" not in out and out.count('"layer" :') == 5
    assert _run(monkeypatch, "runs", folder) == 0 and "SUCCESS" in capsys.readouterr().out
    assert _run(monkeypatch, "gold", path) == 0 and _run(monkeypatch, "live", path) == 0
    assert "Deduplication Applied" in capsys.readouterr().out
    assert _run(monkeypatch, "stream", path, f"{folder}/s", f"{folder}/c") == 0
    raw = files(**{"a.csv": "id,age\n1,3\n2,\n"})
    assert _run(monkeypatch, "clean", raw, f"{folder}/clean") == 0
    assert _run(monkeypatch, "verify", f"{folder}/clean") == 0
    assert "Total rows: 2" in capsys.readouterr().out
