"""What became of every record between two versions of a table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keyed_changes(
    old: DataFrame, new: DataFrame, key: str, ignore: Sequence[str] = (), unique: bool = False,
) -> DataFrame:
    """One row per record that was inserted, updated or deleted: ``key, change, changed, old, new``.

    ``changed`` names the columns of an update whose values differ (null equals null), ``old`` and ``new`` hold the rows as
    they were and are. A column that one version lacks is null there; those in ``ignore`` are not compared. Records of the
    same key, null included, are compared in the order of their values, one by one. Both versions are read once.
    ``unique`` says that a version has a key once, as silver does: then rows meet by the key alone, and of tables bucketed
    by it none is moved; a row without a key has no counterpart.
    """
    names = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c != key]
    compared = [c for c in names if c not in ignore]

    def side(df: DataFrame, name: str):
        whole = F.struct(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None)).alias(c) for c in names])
        orderable = F.to_json(F.struct(*[F.col(f"`{c}`") for c in compared if c in df.columns]))
        place = F.lit(1) if unique else F.row_number().over(Window.partitionBy(F.col(f"`{key}`")).orderBy(orderable))
        return df.select(F.col(f"`{key}`").alias("key"), place.alias("place"), whole.alias("held")).alias(name)

    before, after = side(old, "old"), side(new, "new")
    same = F.col("old.key") == F.col("new.key")
    if not unique:
        same = F.col("old.key").eqNullSafe(F.col("new.key")) & (F.col("old.place") == F.col("new.place"))
    joined = before.join(after, same, "full_outer")
    gone, came = F.col("new.place").isNull(), F.col("old.place").isNull()
    differ = F.array_compact(F.array(F.lit(None).cast("string"), *[
        F.when(~F.col(f"old.held.`{c}`").eqNullSafe(F.col(f"new.held.`{c}`")), c) for c in compared]))
    result = joined.select(
        F.coalesce("old.key", "new.key").alias(key),
        F.when(came, "insert").when(gone, "delete").when(F.size(differ) > 0, "update").alias("change"),
        F.when(~came & ~gone, differ).alias("changed"), F.col("old.held").alias("old"), F.col("new.held").alias("new"))
    return result.where(F.col("change").isNotNull())
