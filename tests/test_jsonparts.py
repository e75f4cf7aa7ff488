import json
import random

import pytest
from pyspark.sql import functions as F

from lakestrata.sources import files as f
from lakestrata.sources import jsonparts, tabular
from tests.conftest import rows


def _value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    text = "".join(rng.choice('ab"\\{}[],: \n\té漢🙂\\\\') for _ in range(rng.randrange(12)))
    if kind < 2:
        return text
    if kind < 4:
        return rng.choice([None, True, 1.50, -3, 10 ** 20])
    if kind < 6:
        return {text + str(i): _value(rng, depth + 1) for i in range(rng.randrange(3))}
    return [_value(rng, depth + 1) for _ in range(rng.randrange(3))]


def _document(rng, n):
    records = [{"id": i, "v": _value(rng), "é\"}": _value(rng)} for i in range(n)]
    gap = rng.choice(["", " ", "\n", " \r\n\t"])
    body = (gap + "," + gap).join(json.dumps(r, ensure_ascii=rng.random() < 0.5) for r in records)
    return rng.choice(["", "﻿", "\n "]) + "[" + gap + body + gap + "]" + rng.choice(["", "\n\n"])


def _whole(path):
    found, problem = tabular._read_document(path)
    return [tabular._pairs(r) for r in found or []], problem


def _parts(path, size, length):
    """The same by stretches, without Spark."""
    state, depth, found, sound = 0, 0, [], True
    for at in range(0, max(size, 1), length):
        part, good = jsonparts.records_of(path, at, length, state, depth, jsonparts.parse_record)
        found += [tabular._pairs(r) for r in part]
        sound &= good
        _, deeper, state = jsonparts.scan(jsonparts.read_range(path, at, length), state)
        depth += int(deeper.sum())
    return found, sound


@pytest.mark.parametrize("length", [1, 2, 3, 7, 64, 1000])
def test_stretches_give_the_records_of_the_whole(tmp_path, length):
    rng = random.Random(length)
    for n in range(25):
        text = _document(rng, rng.choice([0, 1, 2, 9]))
        path = tmp_path / f"{n}.json"
        path.write_bytes(text.encode())
        assert _parts(str(path), path.stat().st_size, length) == (_whole(str(path))[0], True), text


@pytest.mark.parametrize("length", [1, 5, 64])
def test_what_is_wrong_is_found_wherever_it_is(tmp_path, length):
    rng = random.Random(length)
    wrong = ["[", "[]]", "[{}", "[{},]", "[,{}]", "[{} {}]", "[{}] x", "[1]", "[{}, 2, {}]", "[[{}]]", '[{"a": }]', '[{"a": "b}]', "[{}}", "]",
             '[{"a": 1}, [{"b": 2}]]', '[{"a": 1}]\n[]', '[{"a":1}, {"b": tru}]', "[{}\\]", '[\\"{}]', "[{}],"]
    for n in range(12):  # a good document with one byte taken out; it may still be good
        text = _document(rng, 4)
        at = rng.randrange(len(text))
        wrong.append(text[:at] + text[at + 1:])
    for n, text in enumerate(wrong):
        path = tmp_path / f"{n}.json"
        path.write_bytes(text.encode())
        found, problem = _whole(str(path))
        if text.lstrip("﻿ \n")[:1] != "[":
            continue
        got, sound = _parts(str(path), path.stat().st_size, length)
        assert sound == (problem is None), text
        if sound:
            assert got == found


def test_large_arrays_are_read_by_many_tasks(spark, files):
    rng = random.Random(1)
    contents = {f"{n}.json": _document(rng, 60) for n in range(3)}
    contents |= {"bad.json": contents["0.json"].rstrip()[:-1] + ", 7]", "lines.json": '{"id": 1}\n' * 200, "one.json": json.dumps({"id": "x" * 900}, indent=1)}
    path = files(**contents)
    listed = f.list_files(spark, path)
    stretch = 256
    got = tabular.json_records(spark, listed, stretch)
    whole = tabular.json_records(spark, listed)
    bad = got.where("problem IS NOT NULL").select("path").distinct()
    assert rows(bad) == rows(whole.where("problem IS NOT NULL").select("path").distinct()) and bad.count() == 1
    keep = "path NOT LIKE '%bad.json' AND fields IS NOT NULL"
    columns = ["path", "map_entries(fields) AS fields"]
    assert rows(got.where(keep).selectExpr(*columns)) == rows(whole.where(keep).selectExpr(*columns))
    assert got.where("path LIKE '%/0.json'").select("_block").distinct().count() > 5
    assert got.where("path LIKE '%/0.json'").select(F.spark_partition_id().alias("p")).distinct().count() > 5
    assert rows(tabular.scan_json(spark, path, {"id": "string"}, stretch)) == rows(tabular.scan_json(spark, path, {"id": "string"}))
