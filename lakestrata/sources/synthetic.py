"""Synthetic orders: draws with replacement from a set of base records."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import constants as const


def _draw(seed: int, *parts: Column | str, salt: str = "") -> Column:
    """A reproducible 48-bit whole number from a digest of the parts."""
    text = F.concat_ws("|", F.lit(f"{seed}{salt}"), *[
        (F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")


def synthetic_orders(draws: DataFrame, base_records: int = 200, seed: int = 0, key: str = "id") -> DataFrame:
    """One order per row of ``draws``: each picks one of the base records by a digest of its key.

    The base records follow from their number alone, so nothing is joined or collected.
    """
    low, high = const.SYNTHETIC_REVENUE_RANGE
    pick = F.pmod(_draw(seed, key), F.lit(base_records))
    names = F.array(*[F.lit(name) for name in const.SYNTHETIC_PRODUCTS])
    cents = int(round((high - low) * 100)) + 1
    picked = draws.select(F.col(key).alias("draw"), pick.alias("base"))
    product = F.pmod(_draw(seed, "base", salt="p"), F.lit(len(const.SYNTHETIC_PRODUCTS))).cast("int")
    revenue = F.lit(int(low * 100)) + F.pmod(_draw(seed, "base", salt="r"), F.lit(cents))
    return picked.select(
        "draw",
        F.concat(F.lit("J"), (F.col("base") + const.SYNTHETIC_FIRST_ID).cast("string")).alias("order_id"),
        F.lit(const.SYNTHETIC_DATE).alias("order_date"),
        names[product].alias("product"),
        (revenue.cast("double") / F.lit(100.0).cast("double")).alias("revenue"))


def generate_orders(
    spark: SparkSession, total_rows: int = 1000, base_records: int = 200, seed: int = 0
) -> DataFrame:
    return synthetic_orders(spark.range(total_rows), base_records, seed).drop("draw")
