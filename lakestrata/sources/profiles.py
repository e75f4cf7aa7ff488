"""Profiles of any version of a table, from sketches kept beside its data."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.sketches import column_sketches, sketched_profile, united
from lakestrata.sources.storage import file_info
from lakestrata.sources.versioned import VersionedTable

_SCHEMA = "position int, column string, rows bigint, nulls bigint, values binary, numbers binary"


class Profiles:
    """Sketches of what each version of a table wrote, below ``<table>/sketches/version=N``.

    Data of a version never changes, so it is read once for its sketches and not again; a version's profile unites the
    sketches of the data it is made of, and restored or overwritten versions need no new ones.
    """

    def __init__(self, table: VersionedTable):
        self.table, self.spark = table, table.spark

    def _folder(self, number: int) -> str:
        return f"{self.table.path}/sketches/version={number}"

    def note(self, version: int | None = None) -> list[int]:
        """Sketch the data of a version (the latest by default) that has not been; returns the versions that wrote it."""
        return self._note(self.table.contents(version)[0])

    def _note(self, numbers: list[int]) -> list[int]:
        # _SUCCESS is written last, so sketches of a job that died are made anew
        new = [n for n in numbers if file_info(self.spark, f"{self._folder(n)}/_SUCCESS") is None]
        for number in new:
            column_sketches(self.table.written_by(number)).coalesce(1).write.mode("overwrite").parquet(self._folder(number))
        return new

    def profile(self, version: int | None = None) -> DataFrame:
        """Rows, nulls, distinct values and quantiles per column of a version; no data is read that was sketched before.

        A column that some of the data lacks is null there. A version without data has no rows here.
        """
        numbers, rows = self.table.contents(version)
        if not numbers:
            return sketched_profile(self.spark.createDataFrame([], _SCHEMA))
        self._note(numbers)
        parts = self.spark.read.schema(_SCHEMA).parquet(*[self._folder(n) for n in numbers])
        return sketched_profile(united(parts), F.lit(rows).cast("bigint"))
