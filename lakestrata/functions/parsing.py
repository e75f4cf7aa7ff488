"""Lenient parsing. ANSI mode raises on bad input, so every conversion here is a ``try_`` one."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_number(value: Column | str) -> Column:
    return column(value).try_cast("double")


def as_whole(value: Column | str) -> Column:
    """Whole number of a text or number, also if written with a fraction of zero; null for any other."""
    text, number = column(value).cast("string"), as_number(column(value).cast("string"))
    whole = (number == F.floor(number)) & (F.abs(number) < F.lit(2.0 ** 53))
    return F.coalesce(text.try_cast("bigint"), F.when(whole, number.try_cast("bigint")))


def as_day(value: Column | str) -> Column:
    """Date of a text, date or timestamp column; null where it does not parse."""
    return column(value).cast("string").try_cast("date")


def as_moment(value: Column | str) -> Column:
    """Zone-free timestamp of a text, date or timestamp column; null where it does not parse."""
    return column(value).cast("string").try_cast("timestamp_ntz")


def day_literal(as_of: str | None) -> Column:
    """The reference day of a check: the given ISO date, or the day the query runs."""
    return F.to_date(F.lit(as_of)) if as_of else F.current_date()


def moment_literal(as_of: str | None) -> Column:
    return F.lit(as_of).cast("timestamp_ntz") if as_of else F.localtimestamp()
