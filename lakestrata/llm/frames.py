"""Small helpers shared by the operators: tables, text and Arrow batches."""

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.tokens import SPACES
from lakestrata.session import give_back, materialize, work_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_spaces(text: Column) -> Column:
    """The text without blanks, tabs and line breaks (a word separator each); null stays null."""
    return F.translate(text, SPACES, "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def fresh(name: str, taken: Sequence[str]) -> str:
    """A column name based on ``name`` that none of ``taken`` has, ignoring case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def plain_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns called ``c0``, ``c1`` and on, so that added ones cannot clash, and these names by the old."""
    named = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(new) for c, new in named.items()]), named


def given_names(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns that ``plain_names(like)`` gave names to, under their own names again; no others."""
    return df.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(like.columns)])


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back; its shuffle files go as soon as it is written."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return materialize(df, label, folder=folder)
    finally:
        conf.set(_CLEANUP, before)


class Scratch:
    """Work tables that are deleted together, when the block that uses them ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder, self.number = spark, work_folder(spark, label), 0

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        give_back(self.spark, self.folder)

    def table(self, df: DataFrame, label: str) -> DataFrame:
        self.number += 1
        return stored(df, label, f"{self.folder}/{self.number}-{label}")
