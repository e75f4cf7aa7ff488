"""Column-level operators: names, aliases, defaults, fills and audit columns.

None of these shuffles rows. Anything decided from names is decided on the schema, not on data.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata import constants as const
from lakestrata.functions.parsing import as_moment, as_number, as_whole
from lakestrata.functions.text import decoded_path, tidy_name


def add_processing_time(df: DataFrame, name: str = "processing_timestamp") -> DataFrame:
    """Stamp every row with the time of the query (one value per query)."""
    return df.withColumn(name, F.current_timestamp())


def add_source_file(df: DataFrame, name: str = "source_file", full_path: bool = False) -> DataFrame:
    """Name (or whole path) of the file a row was read from; ``df`` must be a file scan."""
    return df.withColumn(
        name, decoded_path("_metadata.file_path" if full_path else "_metadata.file_name"))


def tidy_layout(names: Sequence[str]) -> list[tuple[int, str]]:
    """Positions and tidied names to keep, the first of each repeated name."""
    kept: dict[str, int] = {}
    for position, name in enumerate(names):
        kept.setdefault(tidy_name(name), position)
    return [(position, name) for name, position in kept.items()]


def normalize_headers(df: DataFrame, header: Sequence[str] | None = None) -> DataFrame:
    """Trim and lower-case the names and keep the first of each repeated one.

    ``header`` gives the true names where the scan had to rename repeated ones.
    """
    names = list(header) if header is not None else df.columns
    slots = [f"_c{i}" for i in range(len(df.columns))]
    return df.toDF(*slots).select(
        *[F.col(slots[position]).alias(name) for position, name in tidy_layout(names)])


def alias_names(names: Sequence[str], aliases: Mapping[str, str] = const.ALIASES) -> list[str | None]:
    """Aliased name per column; ``None`` for a column whose target name is already taken."""
    taken: set[str] = set()
    result: list[str | None] = []
    for name in names:
        target = aliases.get(name, name)
        result.append(None if target in taken else target)
        taken.add(target)
    return result


def alias_columns(df: DataFrame, aliases: Mapping[str, str] = const.ALIASES) -> DataFrame:
    """Rename by a fixed map; when two columns meet in one name the first one stays."""
    return df.select(*[
        F.col(f"`{name}`").alias(target)
        for name, target in zip(df.columns, alias_names(df.columns, aliases))
        if target is not None])


def detect_date_column(df: DataFrame) -> str | None:
    """First column, in column order, in which any value holds an ISO date.

    One pass with map-side maxima; a single row of booleans reaches the driver.
    """
    found = date_column_flags(df).first()
    return next((name for name in df.columns if found[name]), None)


def date_column_flags(df: DataFrame) -> DataFrame:
    """One row: per column, whether any of its values holds an ISO date."""
    return df.agg(*[
        F.coalesce(
            F.max(F.col(f"`{name}`").cast("string").rlike(const.ISO_DATE_PATTERN)), F.lit(False)
        ).alias(name)
        for name in df.columns])


def pick_aliases(
    df: DataFrame,
    candidates: Mapping[str, Sequence[str]] = const.ALIAS_CANDIDATES,
    search_dates: bool = True,
) -> DataFrame:
    """Fill missing standard columns from ordered candidate names.

    The id falls back to the first column; the date falls back to the first column whose content
    looks like a date (this needs a pass over the data and is done only when nothing else fits).
    """
    for target, names in candidates.items():
        if target in df.columns:
            continue
        chosen = next((name for name in names if name in df.columns), None)
        if chosen is None and target == "order_id":
            chosen = df.columns[0]
        if chosen is None and target == "order_date" and search_dates:
            chosen = detect_date_column(df)
        if chosen is not None:
            df = df.withColumnRenamed(chosen, target)
    return df


def project_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[F.col(f"`{name}`") for name in wanted if name in df.columns])


def missing_columns(df: DataFrame, required: Sequence[str] = const.REQUIRED_COLUMNS) -> list[str]:
    return [name for name in required if name not in df.columns]


def with_defaults(df: DataFrame, defaults: Mapping[str, Column | str | float | int]) -> DataFrame:
    """Add the columns that are missing; existing ones stay untouched."""
    added = {
        name: value if isinstance(value, Column) else F.lit(value)
        for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(added) if added else df


def cast_known(df: DataFrame, types: Mapping[str, str] = const.ORDER_TYPES) -> DataFrame:
    """Cast the known columns leniently; values that do not convert become null.

    ``5.0`` is the whole number 5. ``conversion_rules`` finds what would become null.
    """
    casts = {
        name: as_whole(F.col(name)) if kind == "bigint" else F.col(name).cast("string").try_cast(kind)
        for name, kind in types.items() if name in df.columns}
    return df.withColumns(casts) if casts else df


def conform(df: DataFrame, types: Mapping[str, str] = const.DECLARED_TYPES) -> DataFrame:
    """Exactly the declared columns, bound by name, cast leniently, null where absent."""
    return df.select(*[
        (F.col(name).cast("string").try_cast(kind) if name in df.columns
         else F.lit(None).cast(kind)).alias(name)
        for name, kind in types.items()])


def fill_constant(df: DataFrame, values: Mapping[str, float | int | str]) -> DataFrame:
    return df.fillna(dict(values))


def fill_mean(df: DataFrame, name: str) -> DataFrame:
    """Fill nulls with the column mean rounded half-even to a whole number (0 if there is none).

    A text column stays text; its mean is that of the values that are numbers.

    The mean is a scalar subquery over a scan of this one column.
    """
    number = F.col(name) if not isinstance(df.schema[name].dataType, T.StringType) else as_number(name)
    mean = df.select(F.bround(F.coalesce(F.avg(number), F.lit(0.0).cast("double")), 0).alias("m")).scalar()
    kind = df.schema[name].dataType
    filler = mean.cast("bigint").cast(kind) if isinstance(kind, T.StringType) else mean.cast(kind)
    return df.withColumn(name, F.coalesce(F.col(name), filler))


def normalize_gold(df: DataFrame) -> DataFrame:
    """Daily gold under display names: lenient narrow types, undated rows dropped, by date."""
    names = const.GOLD_DISPLAY_NAMES
    for old, new in names.items():
        if old in df.columns:
            df = df.withColumnRenamed(old, new)
    df = with_defaults(df, {"total_orders": F.lit(0), "total_revenue": F.lit(0.0).cast("double")})
    orders = F.col("total_orders").cast("string").try_cast("double").try_cast("int")
    revenue = F.col("total_revenue").cast("string").try_cast("double")
    return (
        df.select(
            as_moment("date").alias("date"),
            F.coalesce(orders, F.lit(0)).alias("total_orders"),
            F.coalesce(revenue, F.lit(0.0).cast("double")).cast("float").alias("total_revenue"))
        .where(F.col("date").isNotNull())
        .orderBy("date"))
