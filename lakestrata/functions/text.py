"""Names, counts and labels as text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestrata.functions.parsing import column


def tidy_name(name: str) -> str:
    """Column name as the operators know it: no outer blanks, lower case."""
    return str(name).strip().lower()


def thousands(value: Column | str) -> Column:
    """Whole number with a comma between thousands."""
    return F.format_number(column(value), 0)


def decimals(value: Column, pattern: str) -> Column:
    """Number under a decimal pattern, rounded half-even on its exact value."""
    return F.call_function("format_number", value, F.lit(pattern))


def ratio_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage rounded half-even; 0 where there is nothing to divide by."""
    share = F.try_divide(part.cast("double") * F.lit(100.0).cast("double"), whole.cast("double"))
    rounded = decimals(share, "0." + "0" * digits).cast("double")
    return F.coalesce(rounded, F.lit(0.0).cast("double"))


def growth_label(value: Column | str) -> Column:
    """Signed percentage with one decimal, empty where there is no previous value."""
    c = column(value)
    return F.when(c.isNull(), "").otherwise(F.concat(decimals(c, "+0.0;-0.0"), F.lit("%")))


def file_name_of(path: Column | str) -> Column:
    return F.regexp_extract(column(path), r"([^/]+)$", 1)


def decoded_path(path: Column | str) -> Column:
    """File name or path as it is on storage; a scan's file metadata has it percent-encoded."""
    c = column(path)
    # A plus sign in a path stands for itself.
    plain = F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.when(c.contains("%"), plain).otherwise(c)


def extension_of(path: Column | str) -> Column:
    """Lower-case extension with its dot, empty where the name has none."""
    return F.lower(F.regexp_extract(column(path), r"[^/](\.[^./]*)$", 1))


def fingerprint(columns: list[str]) -> list[Column]:
    """Two independent 64-bit hashes of a row, nulls told apart from absent values.

    Together they identify a row by 16 bytes, so counting distinct rows does not move the rows.
    """
    parts: list[Column] = []
    for name in columns:
        c = F.col(f"`{name}`")
        parts += [c, c.isNull()]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"_fp{seed}") for seed in (0, 1)]
