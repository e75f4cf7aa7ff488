"""Batch medallion: all new files of a folder to bronze, quarantine, validated, silver and gold in one run."""

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import constants as const
from lakestrata.functions.parsing import as_day
from lakestrata.operators import rules as rules_
from lakestrata.operators.columns import add_processing_time, cast_known, fill_constant, with_defaults
from lakestrata.operators.dedup import dedup_by_key
from lakestrata.operators.gold import gold_daily
from lakestrata.plans.live import examine, read_files
from lakestrata.session import Workspace
from lakestrata.sources import files as files_
from lakestrata.sources.daily import DailyGold
from lakestrata.sources.runs import KeyedTable, RunTable
from lakestrata.sources.tabular import POSITION

# Staged columns that are not data of the file.
_ADDED = [*POSITION, "source_file", "rejection_reason", "ingestion_timestamp", "quarantined"]
BATCH_RULES = (*rules_.REJECTION_RULES, *rules_.conversion_rules())


class Medallion:
    """The tables of one medallion below a root folder.

    A run writes its rows under a name of its own into each layer, and records the dispositions of its files last, in
    one file. Only recorded runs are in any reading, so a run that died has changed nothing; its files are taken again
    by the next one. A run reads the keys of silver that lie in the range of its own, and of gold the days it
    touches; its work grows with what is new. One run at a time.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "order_id", buckets: int = 32):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.manifest = f"{self.root}/manifest"
        self.bronze, self.quarantine, self.validated = (
            RunTable(spark, f"{self.root}/{layer}", self.recorded) for layer in const.LAYERS[:3])
        self.silver = KeyedTable(spark, f"{self.root}/{const.LAYERS[3]}", key, buckets, self.recorded)
        self.gold = DailyGold(spark, f"{self.root}/{const.LAYERS[4]}", self.recorded)

    def recorded(self) -> DataFrame:
        """The runs whose rows count."""
        return files_.read_manifest(self.spark, self.manifest).select("run").distinct()

    def run(
        self,
        input_path: str | list[str],
        rules: Sequence[rules_.Rule] = BATCH_RULES,
        fill: Mapping[str, float] | None = None,
        order_by: Sequence[str] | None = None,
        required: Sequence[str] = const.REQUIRED_COLUMNS,
        ratio: float = const.GATE_RATIO,
        ragged: str = "pad",
        multi_line: bool = False,
    ) -> DataFrame:
        """Handle every file that has no disposition yet; returns the dispositions that were recorded.

        ``input_path`` is a folder, or a list of file names. A file is known by path, size and time.
        """
        listed = (files_.list_files(self.spark, input_path) if isinstance(input_path, str)
                  else files_.named_files(self.spark, input_path))
        pending = files_.pending_files(listed, files_.read_manifest(self.spark, self.manifest))
        run = uuid.uuid4().hex
        if not pending.isEmpty():
            with Workspace(self.spark, "medallion") as work:
                self._take(run, work.table(pending, "pending"), work, rules, fill, order_by, required, ratio, ragged, multi_line)
        return files_.read_manifest(self.spark, self.manifest).where(F.col("run") == run).select(
            *files_.FILE_KEY, "disposition", "reason")

    def vacuum(self) -> list[str]:
        """Delete what runs that died have left; returns their names."""
        tables = (self.bronze, self.quarantine, self.validated, self.silver)
        return sorted({run for table in tables for run in table.vacuum()})

    # --- one run ---

    def _take(self, run, files, work, rules, fill, order_by, required, ratio, ragged, multi_line) -> None:
        """Everything between the listing and the dispositions.

        The readable files are parsed once into a staged table of text, split by whether a row is rejected. The
        file gate and all layers are taken from that table. Rows are judged as text and cast afterwards, so
        no value is lost before a rule has seen it. The rows of files that fail the gate are left out by an
        anti join against those few files, which is not planned at all if none fails.
        """
        examined, records = examine(files, keep=work.table)
        header_only = F.coalesce(F.col("has_header") & ~F.col("has_more"), F.lit(False))
        readable = examined.where(F.col("issue").isNull() & ~header_only)
        rows = read_files(self.spark, readable, records, ragged, multi_line)
        if rows is None:
            gate = self.spark.createDataFrame([], "path string, reason string, disposition string")
        else:
            judged = rules_.with_rejection_reason(rows, rules).withColumns({
                "ingestion_timestamp": F.current_timestamp(),
                "quarantined": F.col("rejection_reason").isNotNull()})
            staged = work.table(judged, "staged", ["quarantined"])
            gate = work.table(rules_.file_threshold_gate(
                staged.drop(*_ADDED), "source_path", required, ratio
            ).select(F.col("source_path").alias("path"), "reason", "disposition"), "gate")
            rejected = gate.where(F.col("reason").isNotNull()).select(F.col("path").alias("source_path"))
            if not rejected.isEmpty():
                staged = staged.join(rejected, "source_path", "left_anti")
            self._load(staged.drop("source_path"), fill, order_by, run)
        files_.record_dispositions(self._dispositions(examined, header_only, gate), self.manifest, run)

    def _load(self, staged: DataFrame, fill, order_by, run: str) -> None:
        if staged.isEmpty():
            return
        self.bronze.write(staged.drop("quarantined", "rejection_reason", *POSITION), run)
        bad = staged.where(F.col("quarantined")).drop("quarantined", *POSITION)
        if not bad.isEmpty():
            self.quarantine.write(bad, run)
        good = cast_known(staged.where(~F.col("quarantined")).drop("quarantined", "rejection_reason"))
        self.validated.write(good.drop(*POSITION), run)
        # a column to be filled is there whatever files came together
        fill = {"revenue": 0.0} if fill is None else fill
        good = with_defaults(good, {name: F.lit(value) for name, value in fill.items()})
        clean = dedup_by_key(good, self.key, order_by or POSITION).drop(*POSITION)
        new = self.silver.without_known(clean)
        self.silver.write(add_processing_time(fill_constant(new, fill) if fill else new), run)
        self.gold.apply(gold_daily(self.silver.written(run), as_day("order_date"), self.key), run)

    def _dispositions(self, examined: DataFrame, header_only, gate: DataFrame) -> DataFrame:
        unsupported = ~F.col("supported")
        judged = examined.withColumn("header_only", header_only).join(
            gate.withColumnRenamed("reason", "gate_reason"), "path", "left")
        return judged.select(
            *files_.FILE_KEY,
            F.when(unsupported, "unsupported")
            .when(F.col("issue").isNotNull() | F.col("header_only"), "rejected")
            .otherwise(F.coalesce("disposition", F.lit("rejected"))).alias("disposition"),
            F.when(F.col("issue").isNotNull(), F.col("issue.Reason"))
            .when(F.col("header_only") | F.col("disposition").isNull(), "empty")
            .otherwise(F.col("gate_reason")).alias("reason"))
