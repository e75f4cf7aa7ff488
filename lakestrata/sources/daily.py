"""Daily gold kept up to date by what each run adds."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.session import Workspace
from lakestrata.sources.runs import RUN, overwrite_parts
from lakestrata.sources.storage import file_info

DAY, MONTH = "order_date", "order_month"
_TOTALS = {"total_orders_per_day": "bigint", "total_revenue_per_day": "double"}
_SCHEMA = ", ".join([f"{DAY} date", *[f"{name} {kind}" for name, kind in _TOTALS.items()], f"{RUN} string", f"{MONTH} string"])


class DailyGold:
    """Orders and revenue per day as Parquet partitioned by month, two rows a day at most.

    One row sums up the recorded runs, the other is the last run's own part. A run rewrites the months it touches, from
    their rows and its own totals: no other month and no order is read. Until a run is recorded its part is in no
    reading, and the next run to touch the month leaves it out, so a run that died or is repeated counts once. Months keep
    the files few; a month has some sixty rows.
    """

    def __init__(self, spark: SparkSession, path: str, recorded: Callable[[], DataFrame]):
        self.spark, self.path, self.recorded = spark, path.rstrip("/"), recorded

    def _parts(self) -> DataFrame:
        if file_info(self.spark, self.path) is None:
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(self.path)

    def touched(self, months: list[str]) -> DataFrame:
        """The rows of some months, whether they count or not; only the files of these are opened."""
        return self._parts().where(F.col(MONTH).isin(months))

    def apply(self, daily: DataFrame, run: str) -> None:
        """Add the totals of a run's new orders (``gold_daily``); rows without a day are none of them."""
        with Workspace(self.spark, "gold") as work:
            day = F.col(DAY).cast("date")
            own = work.table(daily.where(day.isNotNull()).select(
                day.alias(DAY), *[F.col(name).cast(kind).alias(name) for name, kind in _TOTALS.items()],
                F.lit(run).alias(RUN), F.date_format(day, "yyyy-MM").alias(MONTH)), "own")
            months = [row[MONTH] for row in own.select(MONTH).distinct().collect()]  # as many as the calendar has
            if not months:
                return
            counted = self.touched(months).where(F.col(RUN) != run).join(self.recorded(), RUN, "left_semi")
            before = counted.groupBy(MONTH, DAY).agg(*[F.sum(name).alias(name) for name in _TOTALS], F.max(RUN).alias(RUN))
            overwrite_parts(work.table(before.unionByName(own), "now").repartition(MONTH), self.path, MONTH)

    def read(self) -> DataFrame:
        """One row per day: ``order_date, total_orders_per_day, total_revenue_per_day``."""
        return self._parts().join(self.recorded(), RUN, "left_semi").groupBy(DAY).agg(
            *[F.sum(name).alias(name) for name in _TOTALS])
