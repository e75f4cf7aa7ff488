"""Counts and bounds of Parquet tables from the footers of their files, without a page of data."""

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.session import materialize

#: Kinds whose bounds footers hold exactly. Those of texts may be cut, those of fractions are missing if there is a NaN.
BOUNDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)
_SETTINGS = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}


@contextmanager
def pushdown(spark: SparkSession) -> Iterator[None]:
    """While this lasts, Parquet tables are opened so that aggregates can be answered by their footers."""
    before = {name: spark.conf.get(name) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def totals(table: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``rows`` and, for each column, ``<column>_held`` (values that are not null) and, if its kind is ``BOUNDED``, ``_low``
    and ``_high``; per partition if ``by`` names partition columns. Nested columns are left out."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    wanted = [f for f in table.schema if f.name not in by and (columns is None or f.name in columns)]
    counted = [f for f in wanted if not isinstance(f.dataType, nested)]
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for f in counted:
        column = F.col(f"`{f.name}`")
        aggregates.append(F.count(column).alias(f"{f.name}_held"))
        if isinstance(f.dataType, BOUNDED):
            aggregates += [F.min(column).alias(f"{f.name}_low"), F.max(column).alias(f"{f.name}_high")]
    return table.groupBy(*[F.col(f"`{name}`") for name in by]).agg(*aggregates)


def footer_totals(spark: SparkSession, path: str, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The ``totals`` of a Parquet table, from its footers.

    A file may have a group of rows in which a column is null throughout, and then holds no bounds for it; the table is
    scanned if there is one. An empty table has no rows, no values and null bounds; per partition, it has no row.
    """
    try:
        with pushdown(spark):
            found = materialize(totals(spark.read.parquet(path), columns, by), "footers")
    except (PySparkException, Py4JJavaError) as error:
        if "No min/max found" not in str(error):
            raise
        found = materialize(totals(spark.read.parquet(path), columns, by), "footers")
    counts = [name for name in found.columns if name not in by and (name == "rows" or name.endswith("_held"))]
    # the sum of the counts of no files is null
    return found.withColumns({name: F.coalesce(F.col(f"`{name}`"), F.lit(0).cast("bigint")) for name in counts})
