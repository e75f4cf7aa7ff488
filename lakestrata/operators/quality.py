"""Data-quality checks as rows.

A layer is measured by two aggregates: one scan that counts every per-row condition with map-side
counters (no shuffle of rows), and one scan of the id column alone that counts rows per id. The check
rows are then laid out from that single row of numbers.
"""

from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import constants as const
from lakestrata.operators.dedup import first_per_key, repeated_keys
from lakestrata.functions import predicates as p
from lakestrata.functions.text import decimals, ratio_pct, thousands

CHECK_SCHEMA = "layer string, check_no int, name string, status string, message string, row_count bigint"


@dataclass
class LayerChecks:
    """The checks of one layer, with what is known of the layer without reading it."""

    layer: str
    checks: DataFrame
    path: str = ""
    columns: list[str] = field(default_factory=list)


@dataclass
class Check:
    name: str
    status: Column
    message: Column
    applies: Column | None = None


def _status(problem: Column, bad: str) -> Column:
    return F.when(problem, bad).otherwise("PASS")


def _say(template: str, *values: Column | str) -> Column:
    return F.format_string(template, *[F.lit(v) if isinstance(v, str) else v for v in values])


def _check_rows(stats: DataFrame, layer: str, checks: Sequence[Check]) -> DataFrame:
    """Turn the one row of numbers into one row per check that applies."""
    entries = []
    for number, check in enumerate(checks, start=1):
        entry = F.struct(
            F.lit(layer).alias("layer"), F.lit(number).alias("check_no"),
            F.lit(check.name).alias("name"), check.status.alias("status"),
            check.message.alias("message"), F.col("total").alias("row_count"))
        entries.append(entry if check.applies is None else F.when(check.applies, entry))
    return stats.select(F.inline(F.array_compact(F.array(*entries))))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Blank count and percentage per column, one scan for all columns."""
    present = [name for name in columns if name in df.columns]
    stats = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(p.is_blank(name)).alias(f"n{i}") for i, name in enumerate(present)])
    entries = [
        F.struct(
            F.lit(name).alias("column"), F.col(f"n{i}").alias("nulls"),
            ratio_pct(F.col(f"n{i}"), F.col("total")).alias("pct"))
        for i, name in enumerate(present)]
    return stats.select(F.inline(F.array(*entries)))


def id_counts(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Rows per id (null is one id); partial counts leave each map task, not rows."""
    return df.groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("n"))


def duplicate_surplus(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Rows beyond the first of each id, and their share."""
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return id_counts(df, key).agg(
        rows.alias("rows"), (rows - F.count(F.lit(1))).alias("surplus")
    ).withColumn("pct", ratio_pct(F.col("surplus"), F.col("rows")))


def duplicate_members(
    df: DataFrame, key: str = "order_id", order_by: Sequence[str] | None = None,
    samples: int = const.LIVE_SAMPLE_IDS,
) -> DataFrame:
    """One row: repeated ids, all their rows, and the first few of those ids as text.

    Ids are counted by a hash aggregate. Only the rows of repeated ids are put in order, for the samples: a
    top-n over their first rows (or over the ids, without an order), so no list of ids is ever gathered.
    """
    repeated = repeated_keys(df, key).select(F.col("_key").alias("id"), F.col("_n").alias("n"))
    if order_by:
        place = F.struct(*order_by).alias("at")
        rows = df.select(F.col(key).alias("row_id"), place).join(
            repeated.select("id"), F.col("row_id").eqNullSafe(F.col("id")), "left_semi")
        firsts = first_per_key(rows, ["row_id"], ["at"]).select(F.col("row_id").alias("id"), "at")
    else:
        firsts = repeated.select("id", F.struct("id").alias("at"))
    shown = F.coalesce(F.col("id").cast("string"), F.lit("None"))
    top = firsts.orderBy("at", "id").limit(samples).agg(
        F.array_sort(F.collect_list(F.struct("at", shown.alias("id")))).alias("a"))
    names = F.array_join(F.col("a.id"), ", ")
    return repeated.agg(
        F.count(F.lit(1)).alias("ids"), F.coalesce(F.sum("n"), F.lit(0)).alias("members")
    ).withColumn("sample_ids", top.select(names).scalar()).withColumn(
        "suffix", F.when(F.col("ids") > samples, F.format_string(
            const.LIVE_DUPLICATES_MORE, F.col("ids") - samples)).otherwise(""))


# --- batch rule set ----------------------------------------------------------------------------


def batch_checks(df: DataFrame, layer: str, as_of: str | None = None) -> DataFrame:
    """The batch rule set on one layer, one row per check."""
    has = set(df.columns)
    counters = {"total": F.count(F.lit(1))}
    nulls = [name for name in const.BATCH_NULL_COLUMNS if name in has]
    ranges = [name for name in const.BATCH_RANGE_COLUMNS if name in has]
    date = next((name for name in const.BATCH_DATE_COLUMNS if name in has), None)
    for name in nulls:
        counters[f"null_{name}"] = F.count_if(p.is_blank(name))
    for name in ranges:
        counters[f"range_{name}"] = F.count_if(p.is_not_positive(name))
    if date:
        counters["bad_dates"] = F.count_if(p.is_bad_day(date))
        counters["future"] = F.count_if(p.is_after_day(date, as_of))
    reason_kept = "rejection_reason" in has and layer in ("quarantine", "validated")
    if reason_kept:
        absent = F.col("rejection_reason").isNull() | (F.col("rejection_reason") == "")
        counters["reasons"] = F.count_if(absent if layer == "quarantine" else ~absent)
    stats = df.agg(*[c.alias(name) for name, c in counters.items()])
    if "order_id" in has:
        stats = stats.withColumn(
            "surplus", duplicate_surplus(df.select("order_id")).select("surplus").scalar())

    total = F.col("total")
    checks = [Check(
        "row_count", _status(total == 0, "CRITICAL"),
        F.when(total == 0, const.MSG_EMPTY).otherwise(_say(const.MSG_ROWS, thousands(total))))]
    for name in nulls:
        n = F.col(f"null_{name}")
        pct = ratio_pct(n, total)
        over = pct > const.BATCH_NULL_LIMIT_PCT
        checks.append(Check(
            f"null_check_{name}",
            F.when(n == 0, "PASS").when(over, "CRITICAL").otherwise("WARNING"),
            F.when(n == 0, const.MSG_NO_NULLS % name)
            .when(over, _say(const.MSG_NULLS_OVER, n, name, pct.cast("string")))
            .otherwise(_say(const.MSG_NULLS, n, name, pct.cast("string")))))
    if "order_id" in has:
        n = F.col("surplus")
        unique = layer in const.UNIQUE_LAYERS
        text = const.MSG_DUPLICATES_BAD if unique else const.MSG_DUPLICATES_OK
        checks.append(Check(
            "duplicate_order_ids", _status(n > 0, "CRITICAL" if unique else "WARNING"),
            F.when(n == 0, const.MSG_NO_DUPLICATES).otherwise(
                _say(text, n, ratio_pct(n, total).cast("string")))))
    for name in ranges:
        n = F.col(f"range_{name}")
        checks.append(Check(
            f"range_{name}", _status(n > 0, "WARNING"),
            F.when(n == 0, const.MSG_RANGE_OK % name).otherwise(_say(const.MSG_RANGE_BAD, n, name))))
    if date:
        bad, future = F.col("bad_dates"), F.col("future")
        checks.append(Check(
            "date_validity", _status(bad > 0, "CRITICAL"),
            F.when(bad == 0, const.MSG_DATES_OK % date).otherwise(_say(const.MSG_DATES_BAD, bad, date))))
        checks.append(Check(
            "future_dates", _status(future > 0, "WARNING"),
            F.when(future == 0, const.MSG_NO_FUTURE).otherwise(_say(const.MSG_FUTURE, future, date))))
    missing = [name for name in const.LAYER_REQUIRED.get(layer, []) if name not in has]
    listed = ", ".join(f"'{name}'" for name in missing)
    checks.append(Check(
        "schema_check", F.lit("CRITICAL" if missing else "PASS"),
        F.lit(const.MSG_SCHEMA_BAD % listed if missing else const.MSG_SCHEMA_OK)))
    if reason_kept:
        n = F.col("reasons")
        name, good, bad = (
            ("rejection_reason_completeness", const.MSG_REASONS_OK, const.MSG_REASONS_BAD)
            if layer == "quarantine" else
            ("clean_validation", const.MSG_CLEAN_OK, const.MSG_CLEAN_BAD))
        checks.append(Check(
            name, _status(n > 0, "CRITICAL"), F.when(n == 0, good).otherwise(_say(bad, n))))
    if layer == "silver":
        checks.append(Check(
            "silver_row_sanity", F.lit("PASS"), _say(const.MSG_SILVER_ROWS, thousands(total)),
            applies=total > 0))
    return _check_rows(stats, layer, checks)


def failed_layer(spark: SparkSession, layer: str, name: str, message: str, path: str = "") -> LayerChecks:
    """A layer that could not be examined: one critical check."""
    row = [(layer, 1, name, "CRITICAL", message, 0)]
    return LayerChecks(layer, spark.createDataFrame(row, CHECK_SCHEMA), path, [])


def check_layer(
    spark: SparkSession, path: str, layer: str, read=None, as_of: str | None = None
) -> LayerChecks:
    """Batch checks of the table at ``path``; a missing or unreadable table is a finding, not an error.

    ``read(spark, path)`` opens the table (Parquet by default).
    """
    opener = read or (lambda session, where: session.read.parquet(where))
    try:
        df = opener(spark, path)
    except (PySparkException, Py4JJavaError, FileNotFoundError) as error:
        missing = isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"
        if missing:
            return failed_layer(spark, layer, "path_exists", const.MSG_PATH_MISSING % path, path)
        text = str(error)[: const.READ_ERROR_LENGTH]
        return failed_layer(spark, layer, "delta_read", const.MSG_READ_FAILED % text, path)
    return LayerChecks(layer, batch_checks(df, layer, as_of), path, df.columns)


# --- live rule set -----------------------------------------------------------------------------


def input_checks(issues: DataFrame) -> DataFrame:
    """File-level checks from the list of file issues."""
    stats = issues.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(p.mentions("Reason", "Unsupported")).alias("unsupported"),
        F.count_if(p.mentions("Reason", "Corrupted")).alias("corrupted"))
    unsupported, corrupted = F.col("unsupported"), F.col("corrupted")
    return _check_rows(stats, "input", [
        Check(const.LIVE_CHECKS["formats"], _status(unsupported > 0, "WARNING"),
              F.when(unsupported == 0, const.LIVE_FORMATS_OK).otherwise(
                  _say(const.LIVE_FORMATS_BAD, unsupported))),
        Check(const.LIVE_CHECKS["integrity"], _status(corrupted > 0, "CRITICAL"),
              F.when(corrupted == 0, const.LIVE_INTEGRITY_OK).otherwise(
                  _say(const.LIVE_INTEGRITY_BAD, corrupted))),
    ])


def _parts_message(parts: Sequence[tuple[str, Column]], template: str, good: str) -> tuple[Column, Column]:
    """(any found, message): the non-zero counters, joined."""
    if not parts:
        return F.lit(False), F.lit(good)
    found = F.lit(False)
    for _, n in parts:
        found = found | (n > 0)
    listed = F.concat_ws(const.LIVE_PART_SEPARATOR, *[
        F.when(n > 0, _say(template, name, n)) for name, n in parts])
    return found, F.when(found, listed).otherwise(good)


def live_layer_checks(
    df: DataFrame,
    layer: str,
    bronze: DataFrame | None = None,
    order_by: Sequence[str] | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """The live rule set on one layer; an empty layer is only counted and checked for its columns."""
    has = set(df.columns)
    required = const.REQUIRED_COLUMNS
    present = [name for name in required if name in has]
    numeric = [name for name in const.LIVE_NEGATIVE_COLUMNS if name in has]
    counters = {"total": F.count(F.lit(1))}
    for name in present:
        counters[f"null_{name}"] = F.count_if(p.is_blank_or_space(name))
    for name in numeric:
        counters[f"neg_{name}"] = F.count_if(p.is_negative(name))
    if "order_date" in has:
        counters["bad_dates"] = F.count_if(p.is_bad_moment("order_date"))
        counters["future"] = F.count_if(p.is_after_next_day("order_date", as_of))
    stats = df.agg(*[c.alias(name) for name, c in counters.items()])
    if "order_id" in has:
        members = duplicate_members(df, "order_id", order_by)
        stats = stats.withColumn("dup", members.select(F.struct("members", "sample_ids", "suffix")).scalar())
    if layer == "silver" and bronze is not None:
        stats = stats.withColumn("bronze_total", row_count(bronze).scalar())

    total = F.col("total")
    missing = [name for name in required if name not in has]
    checks = [
        Check(const.LIVE_CHECKS["rows"], _status(total == 0, "CRITICAL"),
              F.when(total == 0, const.LIVE_ROWS_BAD).otherwise(
                  _say(const.LIVE_ROWS_OK, thousands(total)))),
        Check(const.LIVE_CHECKS["columns"], F.lit("CRITICAL" if missing else "PASS"),
              F.lit(const.LIVE_COLUMNS_BAD % ", ".join(missing) if missing else const.LIVE_COLUMNS_OK)),
    ]
    always = len(checks)
    if "order_id" in has:
        n = F.col("dup.members")
        checks.append(Check(
            const.LIVE_CHECKS["duplicates"], _status(n > 0, "WARNING"),
            F.when(n == 0, const.LIVE_DUPLICATES_OK).otherwise(
                _say(const.LIVE_DUPLICATES_BAD, n, F.col("dup.sample_ids"), F.col("dup.suffix")))))
    found, message = _parts_message(
        [(name, F.col(f"null_{name}")) for name in present], const.LIVE_NULLS_PART, const.LIVE_NULLS_OK)
    checks.append(Check(const.LIVE_CHECKS["nulls"], _status(found, "CRITICAL"), message))
    found, message = _parts_message(
        [(name, F.col(f"neg_{name}")) for name in numeric],
        const.LIVE_NEGATIVES_PART, const.LIVE_NEGATIVES_OK)
    checks.append(Check(const.LIVE_CHECKS["negatives"], _status(found, "WARNING"), message))
    if "order_date" in has:
        bad, future = F.col("bad_dates"), F.col("future")
        checks.append(Check(
            const.LIVE_CHECKS["dates"], _status(bad > 0, "WARNING"),
            F.when(bad == 0, const.LIVE_DATES_OK).otherwise(_say(const.LIVE_DATES_BAD, bad))))
        checks.append(Check(
            const.LIVE_CHECKS["future"], _status(future > 0, "WARNING"),
            F.when(future == 0, const.LIVE_FUTURE_OK).otherwise(_say(const.LIVE_FUTURE_BAD, future))))
    if layer == "silver" and bronze is not None and "order_id" in has:
        removed = F.col("bronze_total") - total
        share = F.coalesce(
            F.try_divide(removed.cast("double") * F.lit(100.0).cast("double"), F.col("bronze_total")),
            F.lit(0.0).cast("double"))
        checks.append(Check(
            const.LIVE_CHECKS["dedup"], F.lit("PASS"),
            _say(const.LIVE_DEDUP, removed, decimals(share, "0.0"), thousands(total))))
    for check in checks[always:]:
        check.applies = total > 0
    return _check_rows(stats, layer, checks)


def live_checks(
    issues: DataFrame, bronze: DataFrame, silver: DataFrame,
    order_by: Sequence[str] | None = None, as_of: str | None = None,
) -> DataFrame:
    """All live checks of the input folder, bronze and silver."""
    return (
        input_checks(issues)
        .unionByName(live_layer_checks(bronze, "bronze", None, order_by, as_of))
        .unionByName(live_layer_checks(silver, "silver", bronze, order_by, as_of)))


# --- roll-up and report ------------------------------------------------------------------------


def rollup(checks: DataFrame, empty_counts_once: bool = False) -> DataFrame:
    """Status and counts per layer. The live report counts an empty layer as one critical failure."""
    critical = F.count_if(F.col("status") == "CRITICAL")
    rows = F.max("row_count")
    if empty_counts_once:
        critical = F.when(rows == 0, F.least(critical, F.lit(1))).otherwise(critical)
    return checks.groupBy("layer").agg(
        rows.alias("row_count"),
        F.count(F.lit(1)).alias("checks_run"),
        F.count_if(F.col("status") == "PASS").alias("passing"),
        critical.alias("critical_failures"),
        F.count_if(F.col("status") == "WARNING").alias("warnings"),
    ).withColumn("status", _severity(F.col("critical_failures"), F.col("warnings")))


def _severity(critical: Column, warnings: Column) -> Column:
    return F.when(critical > 0, "FAIL").when(warnings > 0, "WARN").otherwise("PASS")


def report_totals(layers: DataFrame) -> DataFrame:
    """One row over all layers: rows checked, checks run, passing, issues and the overall status."""
    critical, warnings = F.sum("critical_failures"), F.sum("warnings")
    return layers.agg(
        F.sum("row_count").alias("rows_checked"),
        F.sum("checks_run").alias("checks_run"),
        F.sum("passing").alias("passing"),
        critical.alias("critical_failures"),
        warnings.alias("warnings"),
        (critical + warnings).alias("issues"),
        _severity(critical, warnings).alias("overall_status"))


def quality_report(layers: Sequence[LayerChecks], generated_at: Column | None = None) -> DataFrame:
    """The nested report: one row holding every layer with its checks (a few rows per layer)."""
    spark = layers[0].checks.sparkSession
    checks = layers[0].checks
    for layer in layers[1:]:
        checks = checks.unionByName(layer.checks)
    facts = spark.createDataFrame(
        [(i, item.layer, item.path, item.columns) for i, item in enumerate(layers)],
        "layer_no int, layer string, path string, columns array<string>")
    entry = F.struct("check_no", F.struct("name", "status", "message").alias("check"))
    listed = checks.groupBy("layer").agg(
        F.array_sort(F.collect_list(entry)).alias("entries"),
        F.max("row_count").alias("row_count"),
        F.count_if(F.col("status") == "CRITICAL").alias("critical_failures"),
        F.count_if(F.col("status") == "WARNING").alias("warnings"))
    whole = facts.join(listed, "layer").select(
        "layer_no",
        F.struct(
            "layer", "path",
            _severity(F.col("critical_failures"), F.col("warnings")).alias("status"),
            "row_count", "columns", F.col("entries.check").alias("checks"),
            "critical_failures", "warnings").alias("body"))
    stamp = generated_at if generated_at is not None else F.current_timestamp()
    failed = F.exists("layers", lambda x: x["status"] == "FAIL")
    warned = F.exists("layers", lambda x: x["status"] == "WARN")
    return whole.agg(F.array_sort(F.collect_list(F.struct("layer_no", "body"))).alias("l")).select(
        F.col("l.body").alias("layers")
    ).select(
        stamp.alias("generated_at"),
        F.when(failed, "FAIL").when(warned, "WARN").otherwise("PASS").alias("overall_status"),
        "layers")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, nulls and distinct values per column.

    Rows and nulls of all columns come from one scan. Distinct values are counted column by column from a scan
    of that column alone, so no row is copied per column as several distinct counts in one aggregate would
    do. Anything but a plain scan should be written first.
    """
    names = list(columns or df.columns)
    entries = [F.struct(
        F.lit(i).alias("position"), F.lit(name).alias("column"), F.col("rows"), F.col(f"n{i}").alias("nulls"))
        for i, name in enumerate(names)]
    result = df.agg(F.count(F.lit(1)).alias("rows"), *[
        F.count_if(F.col(f"`{name}`").isNull()).alias(f"n{i}") for i, name in enumerate(names)]).select(
        F.inline(F.array(*entries)))
    distinct = None
    for position, name in enumerate(names):
        values = df.select(F.col(f"`{name}`").alias("v")).where(F.col("v").isNotNull()).distinct()
        one = values.agg(F.lit(position).alias("at"), F.count("v").alias("distinct_values"))
        distinct = one if distinct is None else distinct.unionByName(one)
    result = result.join(distinct, F.col("position") == F.col("at")).drop("at")
    unique_pct = ratio_pct(F.col("distinct_values"), F.col("rows"))
    return result.withColumn("null_pct", ratio_pct(F.col("nulls"), F.col("rows"))).withColumn(
        "unique_pct", unique_pct)
