"""Versioned Parquet tables as plain folders.

``<table>/data/version=N`` holds the immutable rows written by commit N, and
``<table>/commits/version=N`` the record of that commit, written last. A reader sees only versions
with a commit record, and reads exactly the data folders that record names. Finding the newest version
takes a listing of names, and reading a version one record. One writer at a time.
"""

import json
import re
import time

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata import constants as const
from lakestrata.operators.asof import accepted_vs_rejected, rejected_ratio
from lakestrata.sources.storage import file_info, list_folder

# ``num_*`` describe what the commit wrote, ``total_rows`` the table after it. ``spans`` are the ranges of data
# versions that make up the table; consecutive appends are one range.
COMMIT_SCHEMA = (
    "version bigint, timestamp bigint, operation string, operationParameters map<string,string>, "
    "userName string, isBlindAppend boolean, engineInfo string, num_rows bigint, num_files bigint, "
    "num_bytes bigint, total_rows bigint, spans array<struct<first: bigint, last: bigint>>, "
    "schema_json string, txn string")


def _versions(commit: Row) -> list[int]:
    return [v for span in commit["spans"] for v in range(span["first"], span["last"] + 1)]


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # --- reading ---

    def commits(self) -> DataFrame:
        """One row per commit; empty for a table that was never written."""
        if self.latest_version() < 0:
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/commits/*")

    def _commit(self, version: int | None = None) -> Row | None:
        """The record of one commit (the latest by default)."""
        number = self.latest_version() if version is None else version
        record = f"{self.path}/commits/version={number}"
        if number < 0 or file_info(self.spark, record) is None:
            return None
        return self.spark.read.schema(COMMIT_SCHEMA).json(record).first()

    def latest_version(self) -> int:
        """The newest version, -1 before the first commit."""
        found = (re.search(r"/version=(\d+)$", info.path) for info in list_folder(self.spark, f"{self.path}/commits"))
        return max((int(m[1]) for m in found if m), default=-1)

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, latest by default.

        Only the folders of that version are listed, and the schema comes from the commit record, so no
        footers are merged; a column that older data lacks reads as null.
        """
        commit = self._commit(version)
        if commit is None:
            raise FileNotFoundError(f"no such version of {self.path}: {version}")
        schema = T.StructType.fromJson(json.loads(commit["schema_json"]))
        return self._rows(_versions(commit), schema)

    def _rows(self, versions: list[int], schema: T.StructType) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/version={v}" for v in versions])

    def contents(self, version: int | None = None) -> tuple[list[int], int]:
        """The versions whose data a version (the latest by default) is made of, and its number of rows."""
        commit = self._commit(version)
        if commit is None:
            raise FileNotFoundError(f"no such version of {self.path}: {version}")
        return _versions(commit), commit["total_rows"]

    def written_by(self, version: int) -> DataFrame:
        """The rows that one commit wrote."""
        return self._rows([version], T.StructType.fromJson(json.loads(self._commit(version)["schema_json"])))

    def wrote(self, txn: str) -> bool:
        """Whether a commit of that transaction name exists."""
        return not self.commits().where(F.col("txn") == txn).isEmpty()

    def history(self) -> DataFrame:
        """Commits newest first, with the version as text and the time readable."""
        commits = self.commits().orderBy(F.desc("version"))
        columns = [c for c in const.HISTORY_COLUMNS if c in commits.columns]
        return display_history(commits.select(*columns))

    # --- writing ---

    def append(self, df: DataFrame, txn: str | None = None, repeated: bool = True) -> int | None:
        """Add rows as a new version. A ``txn`` that was committed before makes this a no-op.

        Without ``repeated`` the name is known to be new, and earlier commits are not searched for it.
        """
        return self._write(df, "Append", txn, repeated)

    def overwrite(self, df: DataFrame, txn: str | None = None, repeated: bool = True) -> int | None:
        """Replace the content by a new version; earlier versions stay readable."""
        return self._write(df, "Overwrite", txn, repeated)

    def restore(self, version: int) -> int:
        """Make the content of an earlier version current without copying data."""
        target, last = self._commit(version), self._commit()
        if target is None:
            raise FileNotFoundError(f"no such version of {self.path}: {version}")
        number = last["version"] + 1
        self._record(
            number, "RESTORE", {"version": str(version)}, list(target["spans"]), target["schema_json"],
            False, 0, 0, 0, target["total_rows"], None)
        return number

    def _write(self, df: DataFrame, mode: str, txn: str | None, repeated: bool) -> int | None:
        last = self._commit()
        if txn is not None and repeated and last is not None and (last["txn"] == txn or self.wrote(txn)):
            return None
        number = 0 if last is None else last["version"] + 1
        folder = f"{self.path}/data/version={number}"
        # Rows are counted while they are written. A folder left by a crash before its commit is
        # overwritten here; a folder with a commit is never touched.
        counted = Observation()
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(folder)
        rows = counted.get["rows"]
        files = [info for info in list_folder(self.spark, folder) if info.path.endswith(".parquet")]
        kept = [(s["first"], s["last"]) for s in last["spans"]] if last is not None and mode == "Append" else []
        held = last["total_rows"] if kept else 0
        schema = _merged_schema(last["schema_json"] if kept else None, df.schema)
        if kept and kept[-1][1] == number - 1:
            spans = [*kept[:-1], (kept[-1][0], number)]
        else:
            spans = [*kept, (number, number)]
        self._record(
            number, "WRITE", {"mode": mode}, spans, schema.json(), mode == "Append", rows, len(files),
            sum(info.length for info in files), held + rows, txn)
        return number

    def _record(
        self, version, operation, parameters, spans, schema_json, blind, rows, files, size, total, txn
    ) -> None:
        record = Row(
            version=version, timestamp=int(time.time() * 1000), operation=operation,
            operationParameters=parameters, userName=None, isBlindAppend=blind,
            engineInfo=f"Apache-Spark/{self.spark.version}", num_rows=rows, num_files=files,
            num_bytes=size, total_rows=total, spans=spans, schema_json=schema_json, txn=txn)
        # Fails if another writer has recorded the same version.
        self.spark.createDataFrame([record], COMMIT_SCHEMA).coalesce(1).write.mode(
            "errorifexists").json(f"{self.path}/commits/version={version}")

    # --- comparison ---

    def diff(self, before: int, after: int) -> DataFrame:
        """Rows present in only one of two versions, copies counted, marked ``added`` or ``removed``.

        Data folders that both versions share cancel out and are not read.
        """
        old, new = self._commit(before), self._commit(after)
        schema = T.StructType.fromJson(json.loads(new["schema_json"]))
        had, has = set(_versions(old)), set(_versions(new))
        added = self._rows(sorted(has - had), schema).withColumn("_sign", F.lit(1))
        removed = self._rows(sorted(had - has), schema).withColumn("_sign", F.lit(-1))
        return signed_difference(added.unionByName(removed), schema.names)


def signed_difference(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Net copies of every row of a ``_sign``ed union, one output row per surplus copy."""
    net = rows.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.sum("_sign").alias("_net")).where(
        F.col("_net") != 0)
    return net.select(
        *[F.col(f"`{c}`") for c in columns],
        F.when(F.col("_net") > 0, "added").otherwise("removed").alias("change"),
        F.explode(F.sequence(F.lit(1), F.abs("_net"))).alias("_copy")).drop("_copy")


def _merged_schema(previous: str | None, added: T.StructType) -> T.StructType:
    """Columns of the table so far, then new ones; types must agree."""
    if previous is None:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in added])
    fields = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(previous))}
    for f in added:
        if fields.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} changes its type from {fields[f.name]} to {f.dataType}")
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def moment_of(ms: Column | str) -> Column:
    """UTC time of epoch milliseconds, whatever the time zone of the session."""
    value = F.col(ms) if isinstance(ms, str) else ms
    seconds = (value / F.lit(1000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def display_history(commits: DataFrame) -> DataFrame:
    """Commit rows for display: readable time, version as text."""
    return commits.withColumns({
        name: value for name, value in {
            "timestamp": F.date_format(moment_of("timestamp"), const.TIMESTAMP_FORMAT),
            "version": F.col("version").cast("string"),
            "operationParameters": F.to_json("operationParameters"),
        }.items() if name in commits.columns})


def with_pending(history: DataFrame, pending: dict = const.PENDING_BRONZE) -> DataFrame:
    """The history under an extra first row for the run in progress."""
    kinds = ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'string'}" for k, v in pending.items())
    first = history.sparkSession.createDataFrame([tuple(pending.values())], kinds)
    return first.unionByName(history, allowMissingColumns=True)


def version_trend(
    accepted: DataFrame, rejected: DataFrame, last: int = const.TREND_VERSIONS
) -> DataFrame:
    """The newest versions, oldest first: accepted rows, and rejected rows as of that time."""
    return accepted_vs_rejected(accepted, rejected, last).select(
        F.concat(F.lit("v"), F.col("version").cast("string")).alias("version"),
        F.date_format(moment_of("timestamp"), const.TIME_FORMAT).alias("time"),
        F.col("clean_rows").alias("clean"), F.col("rejected_rows").alias("rejected"),
        F.col("version").alias("version_no")).orderBy("version_no")


def rca_trend(accepted: DataFrame, rejected: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Rows, rejected share and check score for every version of an accepted-rows table."""
    return rca_view(accepted_vs_rejected(accepted, rejected), scores)


def rca_view(trend: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Per version: rows, rejected share and, if given, the share of quality checks passed.

    ``scores`` has ``version``, ``passing`` and ``checks_run``.
    """
    result = trend.select(
        "version", "clean_rows", "rejected_rows",
        rejected_ratio(F.col("clean_rows"), F.col("rejected_rows")).alias("rejection_ratio"))
    if scores is not None:
        score = F.try_divide(F.col("passing").cast("double"), F.col("checks_run").cast("double"))
        result = result.join(scores.select("version", score.alias("dq_score")), "version", "left")
    return result
