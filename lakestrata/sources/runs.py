"""Tables of many runs: Parquet partitioned by run, of which a repeated run replaces its own part.

Writes use dynamic partition overwrite, so writing a run again leaves one copy of its rows. What counts is what ``recorded``
names: the rows of a run that died before it was recorded are in no reading, and ``vacuum`` deletes them. One writer
at a time.
"""

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.sources.storage import delete_folder, file_info, list_folder

RUN = "run"
#: As many recorded runs are broadcast to a reading at most; beyond that Spark decides how to join them.
TOLD_RUNS = 100_000
_DYNAMIC = "spark.sql.sources.partitionOverwriteMode"
_SCHEMAS = "schema_json string"


def overwrite_parts(df: DataFrame, path: str, *by: str) -> None:
    """Write ``df`` below ``path``, replacing just the partitions that it has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


class RunTable:
    """Rows below ``path/rows/run=...``; ``recorded`` gives the runs that count (column ``run``), None counts all."""

    def __init__(self, spark: SparkSession, path: str, recorded: Callable[[], DataFrame] | None = None):
        self.spark, self.path, self.recorded = spark, path.rstrip("/"), recorded
        self.rows, self.schemas = f"{self.path}/rows", f"{self.path}/schemas"

    # --- reading ---

    def schema(self) -> T.StructType | None:
        """All columns that any run has written, in the order of the names of runs; None before the first write.

        There are as many schemas as different ones were written, kept beside the rows so that no footers are merged.
        """
        if file_info(self.spark, self.schemas) is None:
            return None
        kept = self.spark.read.schema(f"{_SCHEMAS}, {RUN} string").parquet(self.schemas)
        merged: dict[str, T.DataType] = {}
        # the first run of each schema decides the order of columns
        found = kept.groupBy("schema_json").agg(F.min(RUN).alias("first")).collect()
        for row in sorted(found, key=lambda r: r["first"]):
            for field in T.StructType.fromJson(json.loads(row["schema_json"])):
                if merged.setdefault(field.name, field.dataType) != field.dataType:
                    raise ValueError(f"column {field.name} has two types: {merged[field.name]} and {field.dataType}")
        return T.StructType([T.StructField(name, kind) for name, kind in merged.items()])

    def exists(self) -> bool:
        return self.schema() is not None

    def read(self) -> DataFrame:
        """The rows that count; a column that a run lacks is null there."""
        return self._counting(self._all_rows(self._known_schema())).drop(RUN)

    def written(self, run: str) -> DataFrame:
        """The rows that one run has written, whether it counts yet or not; no other run's files are opened."""
        return self._all_rows(self._known_schema()).where(F.col(RUN) == run).drop(RUN)

    def runs(self) -> DataFrame:
        """The runs that wrote rows and count: one row (``run``) each."""
        return self._counting(self._all_rows(self._known_schema())).select(RUN).distinct()

    def _known_schema(self) -> T.StructType:
        schema = self.schema()
        if schema is None:
            raise FileNotFoundError(f"nothing was written to {self.path}")
        return schema

    def _all_rows(self, schema: T.StructType) -> DataFrame:
        whole = T.StructType([*schema, T.StructField(RUN, T.StringType())])
        if file_info(self.spark, self.rows) is None:
            return self.spark.createDataFrame([], whole)
        return self._open(whole)

    def _open(self, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.rows)

    def _counting(self, rows: DataFrame) -> DataFrame:
        if self.recorded is None:
            return rows
        runs = self.recorded()
        if runs.count() <= TOLD_RUNS:
            runs = F.broadcast(runs)
        return rows.join(runs, RUN, "left_semi")

    # --- writing ---

    def write(self, df: DataFrame, run: str) -> None:
        """The rows of a run; written again, they replace what it wrote before."""
        self._note(df.schema, run)
        self._put(df.withColumn(RUN, F.lit(run)))

    def _note(self, schema: T.StructType, run: str) -> None:
        named = self.spark.createDataFrame([(T.StructType([T.StructField(f.name, f.dataType) for f in schema]).json(), run)],
                                           f"{_SCHEMAS}, {RUN} string")
        overwrite_parts(named.coalesce(1), self.schemas, RUN)
        self.schema()  # refuses a change of type before any row is written

    def _put(self, rows: DataFrame) -> None:
        overwrite_parts(rows, self.rows, RUN)

    def forget(self, run: str) -> None:
        """Delete what a run wrote."""
        for folder in (self.rows, self.schemas):
            delete_folder(self.spark, f"{folder}/{RUN}={run}")

    def vacuum(self) -> list[str]:
        """Delete the rows of runs that do not count; returns these runs. Only the names of folders are listed."""
        if self.recorded is None:
            return []
        found = [(info.path.rsplit("=", 1)[1],) for info in list_folder(self.spark, self.rows) if f"/{RUN}=" in info.path]
        if not found:
            return []
        dead = self.spark.createDataFrame(found, f"{RUN} string").join(self.recorded(), RUN, "left_anti")
        names = [row[RUN] for row in dead.collect()]
        for name in names:
            self.forget(name)
        return names


class KeyedTable(RunTable):
    """A run table bucketed and sorted by a key, so that looking up keys moves none of its rows.

    The number of buckets is fixed when the folder is first written. Spark finds buckets through a table of the
    session's catalog, which names the folder and is made anew whenever the columns change.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 32,
                 recorded: Callable[[], DataFrame] | None = None):
        super().__init__(spark, path, recorded)
        self.key, self.buckets = key, buckets
        self.name = "runs_" + hashlib.md5(self.path.encode()).hexdigest()

    def _register(self, schema: T.StructType) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.name}`")
        self.spark.sql(
            f"CREATE TABLE `{self.name}` ({columns}) USING parquet PARTITIONED BY (`{RUN}`) CLUSTERED BY (`{self.key}`) "
            f"SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.rows}'")
        if file_info(self.spark, self.rows) is not None:
            self.spark.catalog.recoverPartitions(self.name)

    def _open(self, schema: T.StructType) -> DataFrame:
        self._register(schema)
        return self.spark.table(self.name)

    def _put(self, rows: DataFrame) -> None:
        schema = self._known_schema()
        self._register(T.StructType([*schema, T.StructField(RUN, T.StringType())]))
        every = [F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        before = self.spark.conf.get(_DYNAMIC)
        self.spark.conf.set(_DYNAMIC, "dynamic")
        try:  # one file per bucket
            rows.repartition(self.buckets, self.key).select(*every, RUN).write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(_DYNAMIC, before)

    def without_known(self, rows: DataFrame) -> DataFrame:
        """The given rows whose key the table does not hold.

        The rows are brought to the table's buckets; of the table only the key column is read, of files whose keys lie in
        the range of the given ones, and nothing is moved.
        """
        if not self.exists():
            return rows
        held = self._counting(self._all_rows(self._known_schema()))
        bounds = rows.agg(F.min(self.key), F.max(self.key)).first()
        held = held.where(_between(F.col(self.key), *bounds)).select(self.key)
        return rows.join(held, self.key, "left_anti").select(*[F.col(f"`{c}`") for c in rows.columns])


def _between(value: Column, low, high) -> Column:
    return F.lit(False) if low is None else value.between(F.lit(low), F.lit(high))
