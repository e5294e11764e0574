"""Data-quality checks. A check yields its violations; no rows means it passed.

NULL passes every check but ``not_null``. Checks that look at one row at a
time can be put together with :func:`count_violations`, which answers all of
them from a single scan.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.env import shuffles_removed
from linetally.functions.columns import money, money_out, period_key, total_units

log = logging.getLogger(__name__)


class CheckFailed(AssertionError):
    """An error-severity check has violations."""


@dataclass(frozen=True)
class RowCheck:
    """A named predicate that is true on violating rows."""

    name: str
    violates: Column
    severity: str = "error"


def _only(violates: Column, where: Column | None) -> Column:
    return violates if where is None else violates & where


def not_null(column: str, where: Column | None = None) -> RowCheck:
    return RowCheck(f"not_null({column})", _only(F.col(column).isNull(), where))


def accepted_values(column: str, values: Sequence[str], where: Column | None = None) -> RowCheck:
    return RowCheck(f"accepted_values({column})", _only(~F.col(column).isin(list(values)), where))


def accepted_range(
    column: str, low: float | None = None, high: float | None = None, where: Column | None = None
) -> RowCheck:
    """Both bounds are inclusive."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < low)
    if high is not None:
        outside = outside | (F.col(column) > high)
    return RowCheck(f"accepted_range({column})", _only(outside, where))


def expression_is_true(
    name: str, expression: Column, where: Column | None = None, severity: str = "error"
) -> RowCheck:
    return RowCheck(f"expression({name})", _only(~expression, where), severity)


def violating_rows(df: DataFrame, check: RowCheck) -> DataFrame:
    return df.where(check.violates)


def count_violations(df: DataFrame, table: str, checks: Sequence[RowCheck]) -> DataFrame:
    """One row per check with its violation count, all from one aggregate."""
    counts = df.agg(*[F.count_if(c.violates).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c.name).alias("check_name"),
                F.lit(c.severity).alias("severity"),
                F.col(f"c{i}").alias("violations"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counts.select(F.inline(rows))


def value_counts_outside(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """The values that are not accepted, with their row counts."""
    return violating_rows(df, accepted_values(column, values)).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def not_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. For a single column NULL is no key."""
    rows = df.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def orphans(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, where: Column | None = None
) -> DataFrame:
    """Non-NULL child keys without a parent, with their row counts.

    Child rows are counted per key before the join, so a key with very many
    rows is one row in it.
    """
    rows = child.where(F.col(child_key).isNotNull())
    if where is not None:
        rows = rows.where(where)
    keys = rows.groupBy(F.col(child_key).alias("key")).agg(F.count(F.lit(1)).alias("row_count"))
    return keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def enforce(violations: DataFrame, name: str, severity: str = "error") -> int:
    """Count the violations; raise or warn when there are any."""
    found = violations.count()
    if found:
        if severity == "error":
            raise CheckFailed(f"{name}: {found} violations")
        log.warning("%s: %d violations", name, found)
    return found


def enforce_counts(counts: DataFrame) -> list:
    """Raise for error-severity rows of :func:`count_violations`; return the warnings."""
    findings = Findings()
    findings.add_counts(counts)
    findings.require_none()
    return [f for f in findings.found if f.severity != "error"]


@dataclass(frozen=True)
class Finding:
    name: str
    severity: str
    violations: int


class Findings:
    """What many checks found, so that one that fails does not hide those after it."""

    def __init__(self) -> None:
        self.found: list[Finding] = []

    def _note(self, name: str, severity: str, violations: int) -> None:
        if violations:
            self.found.append(Finding(name, severity, violations))
            log.warning("%s: %d violations", name, violations)

    def add(self, violations: DataFrame, name: str, severity: str = "error") -> None:
        with shuffles_removed(violations.sparkSession):
            self._note(name, severity, violations.count())

    def add_counts(self, counts: DataFrame) -> None:
        """Rows of :func:`count_violations`, one per check."""
        with shuffles_removed(counts.sparkSession):
            found = counts.where("violations > 0").collect()
        for r in found:
            self._note(f"{r['table_name']}.{r['check_name']}", r["severity"], r["violations"])

    def require_none(self) -> None:
        """Raise for all errors together."""
        errors = [f for f in self.found if f.severity == "error"]
        if errors:
            raise CheckFailed("; ".join(f"{f.name}: {f.violations} violations" for f in errors))


# ------------------------------------------------------- checks of this engine


def mixed_cancellation_flags(lines: DataFrame) -> DataFrame:
    """Invoices whose lines do not agree on being a cancellation."""
    flag = F.col("is_cancellation").cast("int")
    # of a flag, the distinct values are those between its minimum and maximum
    return (
        lines.groupBy("invoice_no")
        .agg((F.max(flag) - F.min(flag) + 1).cast("bigint").alias("distinct_flag_values"))
        .where("distinct_flag_values > 1")
    )


def duplicate_rates(stg: DataFrame) -> DataFrame:
    is_copy = F.col("duplicate_occurrence") > 1
    return stg.groupBy("period").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_copy).alias("duplicate_rows"),
        (F.count_if(is_copy).cast("double") / F.count(F.lit(1)).cast("double")).alias("duplicate_rate"),
    )


def duplicate_rate_outside(stg: DataFrame, limit: float, exceptions: Mapping[str, float]) -> DataFrame:
    """Periods over their limit; a known exception has its own, looser one."""
    allowed = F.lit(limit)
    for period, own in exceptions.items():
        allowed = F.when(F.col("period") == period, F.lit(own)).otherwise(allowed)
    known = F.col("period").isin(list(exceptions))
    return (
        duplicate_rates(stg)
        .where(F.col("duplicate_rate") > allowed)
        .withColumn("period_class", F.when(known, "known exception").otherwise("ordinary period"))
    )


def marts_rows_differ(stg: DataFrame, lines: DataFrame, strict: bool = False) -> DataFrame:
    """Periods where the mart does not hold exactly the deduplicated staging rows.

    The plain form compares periods present on both sides. The strict form
    also reports a period missing on either side.
    """
    staged = stg.where("duplicate_occurrence = 1").groupBy("period").agg(F.count(F.lit(1)).alias("staging_count"))
    mart = lines.groupBy("period").agg(F.count(F.lit(1)).alias("marts_count"))
    both = staged.join(mart, "period", "full" if strict else "inner")
    if strict:
        both = both.na.fill(0, ["staging_count", "marts_count"])
    diff = F.col("staging_count") - F.col("marts_count")
    return both.withColumn("diff", diff).where("diff <> 0")


def marts_revenue_differs(
    stg: DataFrame, lines: DataFrame, tolerance: float, strict: bool = False
) -> DataFrame:
    """Periods where mart revenue is not that of the deduplicated staging rows."""
    total = money_out(total_units(money("line_amount")))
    staged = stg.where("duplicate_occurrence = 1").groupBy("period").agg(total.alias("staging_revenue"))
    mart = lines.groupBy("period").agg(total.alias("marts_revenue"))
    both = staged.join(mart, "period", "full" if strict else "inner")
    if strict:
        both = both.na.fill(0.0, ["staging_revenue", "marts_revenue"])
    diff = F.abs(F.col("staging_revenue") - F.col("marts_revenue"))
    return both.withColumn("diff", diff).where(F.col("diff") > tolerance)


def files_listed(raw: DataFrame) -> DataFrame:
    """Periods of RAW that come from more than one file, one row per period, with its files as one text in order.

    Distinct files are found first, which combines before the shuffle; a period's text is as long as its list of files.
    """
    files = raw.select(period_key("partition_year", "partition_month").alias("period"), "source_file").distinct()
    listed = F.expr("listagg(DISTINCT source_file, ', ') WITHIN GROUP (ORDER BY source_file)").alias("file_list")
    return files.groupBy("period").agg(F.count("source_file").alias("distinct_files"), listed).where("distinct_files > 1")


def several_files_per_period(raw: DataFrame) -> DataFrame:
    """Periods of RAW that come from more than one file, one row per file, with the files of its period."""
    files = raw.select(period_key("partition_year", "partition_month").alias("period"), "source_file").distinct()
    # counts per period are few; the files themselves stay spread out
    counts = files.groupBy("period").agg(F.count("source_file").alias("distinct_files")).where("distinct_files > 1")
    return files.join(counts, "period")


def loaded_twice(raw: DataFrame, file_rows: DataFrame) -> DataFrame:
    """Files of which RAW holds another number of rows than the file has."""
    held = raw.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_in_raw"))
    return held.join(file_rows, "source_file").where(F.col("rows_in_raw") != F.col("rows_in_file"))


def unmapped_countries(stg: DataFrame, mapping: DataFrame) -> DataFrame:
    """Countries of staging that the mapping does not list. NULL is reported."""
    known = mapping.select(F.col("retail_country").alias("country"))
    return stg.select("country").distinct().join(known, "country", "left_anti")


def unresolved_mappings(mapping: DataFrame, wb_countries: DataFrame) -> DataFrame:
    """Mapping rows that should resolve to a reference country and do not."""
    resolvable = wb_countries.select(F.col("country_id").alias("worldbank_country_id"))
    return (
        mapping.where("mapping_type <> 'unmappable'")
        .join(resolvable, "worldbank_country_id", "left_anti")
        .select("retail_country", "worldbank_country_id", "mapping_type")
    )


def staging_differs_from_recon(stg: DataFrame, recon: DataFrame, streamed: DataFrame | None = None) -> DataFrame:
    """Periods where staging does not hold the rows the latest run wrote.

    ``streamed``: RAW lines that came as a stream and have records of their own; they are counted out of staging. A line's
    label does not say where it came from, since converted lines may be labelled as streamed.
    """
    staged = stg.groupBy("period").agg(F.count(F.lit(1)).alias("staging_rows"))
    if streamed is not None:
        period = period_key("partition_year", "partition_month").alias("period")
        beside = streamed.groupBy(period).agg(F.count(F.lit(1)).alias("beside"))
        rows = F.coalesce("staging_rows", F.lit(0)) - F.coalesce("beside", F.lit(0))
        staged = staged.join(beside, "period", "full").select("period", rows.alias("staging_rows"))
    written = recon.select("period", F.col("rows_written_back").alias("glue_rows"))
    none = F.lit(0)
    diff = F.coalesce("staging_rows", none) - F.coalesce("glue_rows", none)
    return staged.join(written, "period", "full").withColumn("difference", diff).where("difference <> 0")


def freshness(raw: DataFrame, as_of, warn_days: int, error_days: int) -> DataFrame:
    """Age of the newest load against the limits, at a given time."""
    newest = raw.agg(F.max("loaded_at").alias("newest_load"))
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("newest_load")) / F.lit(86_400_000_000.0)
    return newest.withColumn("age_days", age).withColumn(
        "state",
        F.when(F.col("age_days").isNull() | (F.col("age_days") > error_days), "error")
        .when(F.col("age_days") > warn_days, "warn")
        .otherwise("pass"),
    )
