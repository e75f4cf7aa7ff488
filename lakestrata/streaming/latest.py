"""The newest row of every key, kept in the state of a stream."""

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from lakestrata.operators.dedup import first_per_key
from lakestrata.sources.runs import RunTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = "ranks binary"
_CHANGES = "key string, moment bigint, tie string, body string"
#: Groups of keys that share a row of state.
GROUPS = 4096


class Newest(StatefulProcessor):
    """Holds the ranks of the newest rows of a group of keys, and hands on rows that beat them.

    Every call of a group and every reading of state is a trip between Python and the JVM, of some milliseconds, so many keys
    share one; their ranks are a compressed Arrow table. When the watermark has passed a key's newest row no older one
    can come any more, so its rank is given up: when the group is next written, at the latest when the watermark has
    passed the newest row of all its keys.
    """

    def init(self, handle) -> None:
        self.handle, self.newest = handle, handle.getValueState("newest", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = _unpacked(self.newest.get()[0]) if self.newest.exists() else {}
        best: dict[str, str] = {}
        for part in rows:
            for name, moment, tie, body in zip(part["key"], part["moment"].tolist(), part["tie"], part["body"]):
                rank = held.get(name)
                if rank is None or (moment, tie) > rank:
                    held[name], best[name] = (moment, tie), body
        if not best:
            return
        ranks = [held[name] for name in best]
        passed = timerValues.getCurrentWatermarkInMs()
        kept = {name: rank for name, rank in held.items() if _expiry(rank) > passed}
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if kept:
            self.newest.update((_packed(kept),))
            self.handle.registerTimer(max(_expiry(rank) for rank in kept.values()))
        else:
            self.newest.clear()
        yield pd.DataFrame({"key": list(best), "moment": [rank[0] for rank in ranks], "tie": [rank[1] for rank in ranks],
                            "body": list(best.values())})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def _expiry(rank: tuple[int, str]) -> int:
    """The watermark in ms that lies behind a moment."""
    return rank[0] // 1000 + 1


def _packed(ranks: dict[str, tuple[int, str]]) -> bytes:
    table = pa.table({"key": pa.array(list(ranks), pa.large_string()), "moment": pa.array([m for m, _ in ranks.values()], pa.int64()),
                      "tie": pa.array([t for _, t in ranks.values()], pa.large_string())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(ranks: bytes) -> dict[str, tuple[int, str]]:
    held = pa.ipc.open_stream(bytes(ranks)).read_all()
    return dict(zip(held["key"].to_pylist(), zip(held["moment"].to_pylist(), held["tie"].to_pylist())))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """Settings that a stream takes over when it starts."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class LatestRows:
    """The changes that a stream hands on, by micro-batch, and the newest row per key that they add up to.

    A key's newest row has the greatest moment, then the greatest tie-break text. Rows without a key or a moment
    are left out, and so are rows that come later than ``delay`` behind the newest of all. State lies in RocksDB, a row per
    group of keys, so it may outgrow memory; the number of its partitions, and of groups, stays as the first start had it.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, moment: str, tie: Sequence[str] = ()):
        self.spark, self.key, self.moment, self.tie = spark, key, moment, list(tie)
        self.changes = RunTable(spark, f"{root.rstrip('/')}/changes")

    def start(self, events: DataFrame, checkpoint: str, delay: str, partitions: int | None = None,
              interval: str | None = None, groups: int = GROUPS) -> StreamingQuery:
        """Take new rows of a streaming ``events``; without an interval, what is there, and stop."""
        # equal ranks are decided by the row itself, so that reruns agree
        body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in events.columns]))
        moment = F.col(f"`{self.moment}`")
        tie = F.to_json(F.struct(*[F.format_string("%020d", F.col(c).cast("long")).alias(c) for c in self.tie], body.alias("row")))
        ranked = events.where(F.col(self.key).isNotNull() & moment.isNotNull()).select(
            F.col(self.key).cast("string").alias("key"), moment.cast("timestamp").alias("at"),
            F.unix_micros(moment.cast("timestamp")).alias("moment"), tie.alias("tie"), body.alias("body"))
        share = F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int")
        newest = ranked.withColumn("share", share).withWatermark("at", delay).groupBy("share").transformWithStateInPandas(
            Newest(), outputStructType=_CHANGES, outputMode="Update", timeMode="EventTime")

        def keep(batch: DataFrame, number: int) -> None:
            # a batch that is played again replaces what it wrote; a stream begun anew has an id of its own
            self.changes.write(batch, f"{self.spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}")

        values = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
        if partitions:
            values["spark.sql.shuffle.partitions"] = str(partitions)
        writer = newest.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
        with _settings(self.spark, values):
            return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()

    def read(self, schema: str) -> DataFrame:
        """The newest row per key, as columns of ``schema``."""
        newest = first_per_key(self.changes.read(), ["key"], [F.desc("moment"), F.desc("tie")])
        return newest.select(F.from_json("body", schema).alias("row")).select("row.*")
