import random

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.audit import scan_logs
from lakestrata.sources.tails import last_lines, log_tails
from tests.conftest import rows


class Stream:
    def __init__(self, data):
        self.data, self.read = data, 0

    def read_at(self, length, at):
        self.read += length
        return self.data[at:at + length]


@pytest.mark.parametrize("block", [1, 2, 3, 50])
def test_last_lines_are_those_of_the_whole(block):
    rng = random.Random(block)
    for _ in range(200):
        text = "".join(rng.choice(["a", "é", "\n", "\r\n", "\r", "line", ""]) for _ in range(rng.randrange(30)))
        data = text.encode()
        whole = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        whole = whole[:-1] if whole[-1] == "" else whole
        for count in (0, 1, 3, 100):
            assert last_lines(Stream(data), len(data), count, block) == whole[max(0, len(whole) - count):] * (count > 0), (text, count)


def test_a_large_log_is_read_at_its_end():
    stream = Stream(b"some line of a log\n" * 2_000_000)
    assert len(last_lines(stream, len(stream.data), 500)) == 500 and stream.read < 200_000


def test_tails_are_the_ends_of_scans(spark, files):
    path = files(**{"a.log": "".join(f"line {i}\n" for i in range(1200)), "b.log": "one\r\ntwo", "empty.log": "", "bad.log": b"x\xff\ny\n"})
    tails = log_tails(spark, path, 500)
    assert tails.columns == scan_logs(spark, path).columns
    got = {s: [r.line for r in tails.where(F.col("source") == s).orderBy("position").collect()] for s in ("a.log", "b.log", "empty.log")}
    assert got == {"a.log": [f"line {i}" for i in range(700, 1200)], "b.log": ["one", "two"], "empty.log": []}
    assert rows(tails.where("source = 'bad.log'").select("line")) == rows(scan_logs(spark, path).where("source = 'bad.log'").select("line"))
