"""Row rules, quarantine split, file gate and the issue list."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata import constants as const
from lakestrata.functions import predicates as p
from lakestrata.functions.text import fingerprint
from lakestrata.operators.dedup import duplicate_report


@dataclass(frozen=True)
class Rule:
    """A named reason to reject a row, tested on one column."""

    reason: str
    column: str
    test: callable

    def hit(self) -> Column:
        return self.test(self.column)


REJECTION_RULES = (
    Rule("null_order_id", "order_id", p.is_blank),
    Rule("null_order_date", "order_date", p.is_blank),
    Rule("non_positive_quantity", "quantity", p.is_not_positive),
    Rule("non_positive_unit_price", "unit_price", p.is_not_positive),
    Rule("invalid_order_date", "order_date", p.is_bad_day),
)


def conversion_rules(types: Mapping[str, str] = const.ORDER_TYPES) -> tuple[Rule, ...]:
    """Rules that reject values which casting would turn into null, so that none is lost without a trace."""
    return tuple(
        Rule(f"invalid_{name}", name, lambda c, kind=kind: p.is_unconverted(c, kind)) for name, kind in types.items())


def reason_of(df: DataFrame, rules: Sequence[Rule] = REJECTION_RULES) -> Column:
    """The first broken rule's reason, null for a good row. Rules on absent columns do not apply."""
    branches = [F.when(rule.hit(), rule.reason) for rule in rules if rule.column in df.columns]
    return F.coalesce(*branches) if branches else F.lit(None).cast("string")


def with_rejection_reason(
    df: DataFrame, rules: Sequence[Rule] = REJECTION_RULES, name: str = "rejection_reason"
) -> DataFrame:
    return df.withColumn(name, reason_of(df, rules))


def required_rules(required: Sequence[str] = const.REQUIRED_COLUMNS) -> tuple[Rule, ...]:
    """Rules that reject only nulls in the required columns."""
    return tuple(Rule(f"null_{name}", name, lambda c: F.col(c).isNull()) for name in required)


def split_quarantine(
    df: DataFrame, rules: Sequence[Rule] = REJECTION_RULES
) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows with their reason)."""
    judged = with_rejection_reason(df, rules)
    clean = judged.where(F.col("rejection_reason").isNull()).drop("rejection_reason")
    return clean, judged.where(F.col("rejection_reason").isNotNull())


def default_date_range(df: DataFrame, date: str = "date", year: int = const.DEFAULT_RANGE_YEAR) -> DataFrame:
    """One row (start, end): the data's range cut to one year, or all of it if that leaves nothing."""
    first, last = F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year), F.lit(12), F.lit(31))
    bounds = df.agg(F.min(date).cast("date").alias("lo"), F.max(date).cast("date").alias("hi"))
    start, end = F.greatest("lo", first), F.least("hi", last)
    return bounds.select(
        F.when(start > end, F.col("lo")).otherwise(start).alias("start"),
        F.when(start > end, F.col("hi")).otherwise(end).alias("end"))


def date_range_filter(
    df: DataFrame,
    date: str = "date",
    start: str | None = None,
    end: str | None = None,
    year: int = const.DEFAULT_RANGE_YEAR,
) -> DataFrame:
    """Rows within an inclusive date range; one bound alone means that single day.

    Given bounds are literals and prune partitions at planning time. The default range is a scalar
    subquery, which prunes when the scan starts.
    """
    if start is None and end is None:
        bounds = default_date_range(df, date, year)
        return df.where(F.col(date).between(
            bounds.select("start").scalar(), bounds.select("end").scalar()))
    low, high = start or end, end or start
    return df.where(F.col(date).between(F.lit(low).cast("date"), F.lit(high).cast("date")))


def row_counts_by_copy(df: DataFrame, flags: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct row (and per ``by``), with per-row flags added up.

    Rows are grouped by a 128-bit fingerprint, so 16 bytes per row are moved and copies fold into one
    record before the shuffle.
    """
    plain = [name for name in df.columns if name not in by]
    keyed = df.select(*by, *fingerprint(plain), *[f.cast("int").alias(n) for n, f in flags.items()])
    return keyed.groupBy(*by, "_fp0", "_fp1").agg(
        F.count(F.lit(1)).alias("copies"), *[F.sum(name).alias(name) for name in flags])


def quality_ratios(
    df: DataFrame, required: Sequence[str] = const.REQUIRED_COLUMNS, by: Sequence[str] = ()
) -> DataFrame:
    """Rows, surplus-copy ratio and null ratio over the required columns, whole or per group."""
    has_null = F.lit(False)
    for name in required:
        if name in df.columns:
            has_null = has_null | F.col(name).isNull()
    counts = row_counts_by_copy(df, {"null_rows": has_null}, by)
    rows, unique = F.sum("copies"), F.count(F.lit(1))
    zero = F.lit(0.0).cast("double")
    totals = counts.groupBy(*by).agg(
        F.coalesce(rows, F.lit(0)).alias("total_rows"),
        F.coalesce(F.try_divide((rows - unique).cast("double"), rows), zero).alias("dup_ratio"),
        F.coalesce(F.try_divide(F.sum("null_rows").cast("double"), rows), zero).alias("null_ratio"))
    return totals


def gate_verdict(ratio: float = const.GATE_RATIO) -> Column:
    """Why a file is rejected as a whole, null if it is accepted (the limit itself passes)."""
    return (
        F.when(F.col("total_rows") == 0, "empty")
        .when(F.col("dup_ratio") > ratio, "duplicate_ratio")
        .when(F.col("null_ratio") > ratio, "null_ratio"))


def file_threshold_gate(
    df: DataFrame,
    file_column: str = "source_file",
    required: Sequence[str] = const.REQUIRED_COLUMNS,
    ratio: float = const.GATE_RATIO,
) -> DataFrame:
    """Ratios and verdict of every file that has rows: one row per file."""
    metrics = quality_ratios(df, required, by=[file_column])
    return (
        metrics.withColumn("reason", gate_verdict(ratio))
        .withColumn("disposition", F.when(F.col("reason").isNull(), "processed").otherwise("rejected")))


def rejection_breakdown(df: DataFrame, reason: str = "rejection_reason") -> DataFrame:
    """Rows per reason, most frequent first."""
    return (
        df.where(F.col(reason).isNotNull())
        .groupBy(F.col(reason).alias("reason"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "reason"))


def issue_summary(issues: DataFrame, words: Sequence[str], reason: str = "Reason") -> DataFrame:
    """One row: the number of issues, and per word the number whose reason mentions it."""
    return issues.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(p.mentions(reason, word)).alias(word.lower()) for word in words])


def _row_reasons(df: DataFrame, as_of: str | None) -> Column:
    """All reasons of one row as an array; every broken check adds one entry."""
    tests = [
        F.when(p.is_missing_text(name), const.REASON_MISSING % name)
        for name in const.MISSING_CHECK_COLUMNS if name in df.columns]
    tests += [
        F.when(p.is_negative(name), const.REASON_NEGATIVE % name)
        for name in const.NEGATIVE_CHECK_COLUMNS if name in df.columns]
    if "order_date" in df.columns:
        tests.append(F.when(p.is_after_next_day("order_date", as_of), const.REASON_FUTURE))
    return F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")


def validation_frame(
    bronze: DataFrame,
    file_issues: DataFrame | None = None,
    order_by: Sequence[str] | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """The issue list: file issues, one entry per repeated id, one entry per (row, broken check)."""
    key = "order_id" if "order_id" in bronze.columns else "id"
    parts = [
        bronze.withColumn("Reason", F.explode(_row_reasons(bronze, as_of)))
        .withColumn("Occurrences", F.lit(1).cast("bigint"))]
    if key in bronze.columns:
        n = F.col("Occurrences")
        parts.append(duplicate_report(bronze, key, order_by).withColumn(
            "Reason", F.format_string(const.REASON_DUPLICATE, n, n - 1)))
    if file_issues is not None:
        parts.append(file_issues.withColumn("Occurrences", F.lit(1).cast("bigint")))
    wanted = [c for c in const.ISSUE_COLUMNS if any(c in part.columns for part in parts)]
    result = None
    for part in parts:
        part = part.select(*[F.col(c) for c in wanted if c in part.columns])
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    return result.select(*wanted)
