"""Row predicates used by the rules and the quality checks. All are null-safe booleans."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestrata.functions.parsing import (
    as_day, as_moment, as_number, as_whole, column, day_literal, moment_literal)


def is_blank(value: Column | str) -> Column:
    """Null, or nothing but blanks."""
    c = column(value)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def is_missing_text(value: Column | str) -> Column:
    """Null, the literal text ``nan``, or exactly the empty text (no trimming)."""
    c = column(value)
    return c.isNull() | c.cast("string").isin("nan", "")


def is_blank_or_space(value: Column | str) -> Column:
    """Null, or nothing but white space of any kind (live rule)."""
    c = column(value)
    return c.isNull() | ~c.cast("string").rlike(r"(?U)[^\s\x1c-\x1f]")


def is_unconverted(value: Column | str, kind: str) -> Column:
    """Neither blank nor a value of the type it is to have (whole numbers for ``bigint``)."""
    converted = as_whole(value) if kind == "bigint" else column(value).cast("string").try_cast(kind)
    return ~is_blank(value) & converted.isNull()


def is_not_positive(value: Column | str) -> Column:
    """At most zero; text that is not a number does not count."""
    return F.coalesce(as_number(value) <= 0, F.lit(False))


def is_negative(value: Column | str) -> Column:
    return F.coalesce(as_number(value) < 0, F.lit(False))


def is_bad_day(value: Column | str) -> Column:
    """Not a date; null counts as bad."""
    return as_day(value).isNull()


def is_bad_moment(value: Column | str) -> Column:
    return as_moment(value).isNull()


def is_after_day(value: Column | str, as_of: str | None = None) -> Column:
    """Later than the reference day (batch rule)."""
    return F.coalesce(as_day(value) > day_literal(as_of), F.lit(False))


def is_after_next_day(value: Column | str, as_of: str | None = None) -> Column:
    """Later than one day past the reference moment (live rule)."""
    limit = moment_literal(as_of) + F.expr("INTERVAL 1 DAY")
    return F.coalesce(as_moment(value) > limit, F.lit(False))


def mentions(value: Column | str, text: str) -> Column:
    """Contains the text; null does not."""
    return F.coalesce(column(value).contains(text), F.lit(False))
