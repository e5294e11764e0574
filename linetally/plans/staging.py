"""Staging models: cleaned order lines, reference data, latest audit records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linetally.fixed_values import AGGREGATE_REGION, GDP, POPULATION
from linetally.functions.columns import QUALITY_FIELDS, is_cancellation, line_type, period_key, ratio
from linetally.operators.aggregates import latest_by, pivot_max
from linetally.operators.ranking import ONE_TASK_ROWS, number_within, tasks_for
from linetally.schemas import STG_ORDER
from linetally.sources import ledger, versions
from linetally.sources.files import path_exists
from linetally.sources.raw_orders import all_entries, in_periods, read_all_raw

STG_PARTITION = ("period",)

DUPLICATE_KEY = ("invoice_no", "stock_code", "quantity", "invoice_date", "unit_price")
# load order first; the rest only settles ties, so that a rerun numbers alike
DUPLICATE_ORDER = ("loaded_at", "source_file", "description", "customer_id", "country")

# A period of up to this many rows is not split.
ROWS_PER_BUCKET = 250_000


class SchemaDriftError(ValueError):
    """The staging output no longer has the columns of the existing table."""


# --------------------------------------------------------------------- orders


def clean_lines(raw: DataFrame) -> DataFrame:
    """RAW lines with cleaned text and their period. No line is filtered."""
    return raw.select(
        "invoice_no",
        "stock_code",
        F.trim("description").alias("description"),
        "quantity",
        "invoice_date",
        "unit_price",
        "customer_id",
        F.trim("country").alias("country"),
        "source_system",
        "ingested_at",
        "loaded_at",
        "source_file",
        period_key("partition_year", "partition_month").alias("period"),
    )


def derived_columns(lines: DataFrame) -> DataFrame:
    """Cleaned lines with what follows from a line alone. Added after the shuffle, so that it does not move."""
    return lines.withColumns(
        {
            "invoice_date_only": F.col("invoice_date").cast("date"),
            "is_cancellation": is_cancellation("invoice_no"),
            "line_type": line_type("invoice_no", "quantity", "unit_price"),
            "line_amount": F.col("quantity") * F.col("unit_price"),
        }
    )


def period_buckets(raw: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> tuple[Column, int]:
    """How many buckets each period is split into, and how many tasks they need.

    Sized from row counts per period, which are read from partition folders
    and file footers alone. A period with a third of all rows gets a third of
    the buckets; a small one stays whole.
    """
    counts = raw.groupBy("partition_year", "partition_month").agg(F.count(F.lit(1)).alias("n"))
    period = period_key("partition_year", "partition_month").alias("p")
    sizes = {r["p"]: r["n"] for r in counts.select(period, "n").collect()}  # one row per period
    total = sum(sizes.values())
    by_count: dict[int, list[str]] = {}
    for name, rows in sizes.items():
        count = 1
        while count * rows_per_bucket < rows:
            count *= 2
        by_count.setdefault(count, []).append(name)
    buckets = F.lit(1)
    for count, periods in by_count.items():
        if count > 1:
            buckets = F.when(F.col("period").isin(periods), F.lit(count)).otherwise(buckets)
    all_buckets = sum(count * len(periods) for count, periods in by_count.items())
    at_least = min(all_buckets, raw.sparkSession.sparkContext.defaultParallelism)
    return buckets, max(1, at_least, tasks_for(total))


def stg_orders(
    raw: DataFrame, one_task_rows: int = ONE_TASK_ROWS, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Cleaned lines with otherwise identical ones numbered 1, 2, ... in load order.

    Copies are numbered, never dropped here. The key includes the invoice
    date, so numbering some periods alone gives the numbers of the whole, and
    one shuffle by period and key bucket serves the numbering and the write.
    """
    order = [F.col(c).asc_nulls_first() for c in DUPLICATE_ORDER]
    buckets, tasks = period_buckets(raw, rows_per_bucket)
    lines = clean_lines(raw).withColumn("bucket", F.pmod(F.xxhash64(*DUPLICATE_KEY), buckets))
    numbered = number_within(
        lines, DUPLICATE_KEY, order, "duplicate_occurrence", one_task_rows, ("period", "bucket"), tasks
    )
    return derived_columns(numbered).select(*STG_ORDER.fieldNames())


def read_stg(spark: SparkSession, table: str) -> DataFrame:
    """Staging as it is now; a rebuild that ends later does not change what this frame reads."""
    return versions.read(spark, table, STG_ORDER)


def require_same_columns(expected: StructType, found: StructType) -> None:
    """Raise when columns were added, removed or retyped."""
    want = {(f.name, f.dataType.simpleString()) for f in expected.fields}
    have = {(f.name, f.dataType.simpleString()) for f in found.fields}
    if want != have:
        raise SchemaDriftError(f"missing or retyped: {sorted(want - have)}; new: {sorted(have - want)}")


def _write_stg(rows: DataFrame | None, table: str, spark: SparkSession, gone: Iterable[str] = ()) -> None:
    """Switch periods to these rows, and take the others that are gone out, in one step."""
    new = None
    if rows is not None:
        existing = versions.stored_schema(spark, table)
        if existing.fields:
            require_same_columns(existing, rows.schema)
        # stg_orders leaves its rows laid out by period already
        new = versions.prepare(rows, table, STG_PARTITION)
    ledger.strike(spark, table, [p.split("=", 1)[1] for p in {*gone, *(new.folders if new else ())}])
    versions.replace(spark, table, STG_PARTITION, new, gone)


def build_stg_orders(raw: DataFrame, table: str) -> None:
    """First build, or a rebuild of every period RAW holds."""
    _write_stg(stg_orders(raw), table, raw.sparkSession)


def touched_periods(raw: DataFrame, stg: DataFrame | None) -> list[str]:
    """Periods whose rows or newest load differ between RAW and staging (all of RAW's without staging).

    The mark is kept per period: one for the whole table would hide a period
    loaded before another one was reprocessed. A period RAW no longer holds,
    or holds fewer rows of, differs too.
    """
    state = [F.count(F.lit(1)).alias("n"), F.max("loaded_at").alias("newest")]
    period = period_key("partition_year", "partition_month").alias("period")
    held = raw.groupBy(period).agg(*state).where(F.col("period").isNotNull())
    if stg is not None:
        staged = stg.groupBy("period").agg(*[s.alias(f"stg_{n}") for s, n in zip(state, ("n", "newest"), strict=True)])
        same = F.col("n").eqNullSafe(F.col("stg_n")) & F.col("newest").eqNullSafe(F.col("stg_newest"))
        held = held.join(staged, "period", "full").where(~same)
    return sorted(r["period"] for r in held.select("period").collect())  # one row per period


def rebuild_periods(spark: SparkSession, raw: DataFrame, table: str, periods: Iterable[str]) -> None:
    """Replace whole staging periods with what RAW holds for them now.

    Every raw row of a period is read, not only the new ones, so a second
    file of a month adds to the first instead of erasing it. A period RAW no
    longer holds is removed.
    """
    periods = list(periods)
    if not periods:
        return
    slice_ = raw.where(in_periods(periods))
    period = period_key("partition_year", "partition_month").alias("period")
    held = slice_.select(period).distinct().count() > 0
    _write_stg(stg_orders(slice_) if held else None, table, spark, [f"period={p}" for p in periods])


def refresh_stg_orders(
    spark: SparkSession, raw: DataFrame, table: str, reprocess: Iterable[str] | None = None
) -> list[str]:
    """Incremental run: rebuild the named periods, or those that differ from RAW.

    Returns the periods rebuilt.
    """
    if reprocess is not None:
        periods = list(reprocess)
    else:
        periods = touched_periods(raw, read_stg(spark, table) if versions.exists(spark, table) else None)
    rebuild_periods(spark, raw, table, periods)
    return periods


def stg_entries(spark: SparkSession, table: str) -> DataFrame:
    """The ledger of staging. No row of staging is read but of unmeasured periods."""
    return ledger.brought_up(spark, table, lambda periods: read_stg(spark, table).where(F.col("period").isin(periods)))


def differing_periods(raw: DataFrame, stg: DataFrame) -> DataFrame:
    """Periods whose ledger entries differ in rows, newest load or content, or that stand on one side only."""
    r, s = raw.alias("r"), stg.alias("s")
    same = F.col("r.n").eqNullSafe(F.col("s.n")) & F.col("r.newest").eqNullSafe(F.col("s.newest")) & ledger.same_content(ledger.CLEAN_SUMS, "r", "s")
    return r.join(s, F.col("r.period") == F.col("s.period"), "full").where(~same).select(F.coalesce("r.period", "s.period").alias("period"))


def refresh_from_ledgers(spark: SparkSession, raw: str, stream_raw: str, table: str) -> list[str]:
    """Incremental run over stored tables: rebuild the periods in which the ledgers of RAW and staging differ.

    Neither table is scanned to find them. Returns the periods rebuilt.
    """
    differ = differing_periods(all_entries(spark, raw, stream_raw), stg_entries(spark, table))
    periods = sorted(r["period"] for r in differ.collect())  # one row per period
    rebuild_periods(spark, read_all_raw(spark, raw, stream_raw), table, periods)
    stg_entries(spark, table)
    return periods


# ------------------------------------------------------------- reference data


def stg_worldbank_countries(raw_countries: DataFrame) -> DataFrame:
    """Countries without the aggregates, which carry the literal region id ``NA``."""
    return raw_countries.where(
        F.col("region_id").isNotNull() & (F.col("region_id") != AGGREGATE_REGION)
    ).select(
        "country_id",
        "iso2_code",
        "country_name",
        "region_id",
        "region_name",
        "income_level_id",
        "income_level_name",
        "lending_type_id",
        F.nullif(F.trim("capital_city"), F.lit("")).alias("capital_city"),
        F.col("longitude").try_cast("double").alias("longitude"),
        F.col("latitude").try_cast("double").alias("latitude"),
        "source_system",
        "ingested_at",
        "loaded_at",
    )


def stg_worldbank_indicators(raw_indicators: DataFrame) -> DataFrame:
    """One row per country and year, with the indicators as columns."""
    wide = (
        raw_indicators.where(F.col("country_id").isNotNull())
        .groupBy("country_id", "year")
        .agg(
            *pivot_max("indicator_id", "value", {GDP: "gdp_usd", POPULATION: "population"}),
            F.max("source_system").alias("source_system"),
            F.max("ingested_at").alias("ingested_at"),
            F.max("loaded_at").alias("loaded_at"),
        )
    )
    per_head = F.when(F.col("population") > 0, ratio(F.col("gdp_usd"), F.col("population")))
    return wide.select(
        "country_id",
        "year",
        "gdp_usd",
        "population",
        per_head.alias("gdp_per_capita_usd"),
        "source_system",
        "ingested_at",
        "loaded_at",
    )


# -------------------------------------------------------------- audit records


def read_audit_files(spark: SparkSession, audit: str) -> DataFrame:
    """One VARIANT per stored audit record, which may span lines, with its file."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(audit, wholetext=True)
        .select(F.expr("parse_json(value)").alias("recon_record"), F.col("_metadata.file_path").alias("source_file"))
    )


def load_recon_raw(spark: SparkSession, audit: str, table: str, loaded_at: datetime | None = None) -> None:
    """Append audit files that are not in the table yet. History stays."""
    records = read_audit_files(spark, audit)
    if path_exists(spark, table):
        held = spark.read.parquet(table).select("source_file")
        records = records.join(held, "source_file", "left_anti").select("recon_record", "source_file")
    stamp = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    records.withColumn("loaded_at", stamp).write.mode("append").parquet(table)


def recon_fields(recon_raw: DataFrame) -> DataFrame:
    """All audit records with typed columns."""

    def get(path: str, kind: str, name: str | None = None):
        return F.try_variant_get("recon_record", f"$.{path}", kind).alias(name or path.split(".")[-1])

    return recon_raw.select(
        get("period", "string"),
        get("run_id", "string"),
        get("job_name", "string"),
        get("recon_at", "timestamp"),
        get("source_lines", "bigint"),
        get("corrupt_rows", "bigint"),
        get("undated_rows", "bigint"),
        get("expected_rows", "bigint"),
        get("rows_written_back", "bigint"),
        get("difference", "bigint"),
        get("balanced", "boolean", "glue_balanced"),
        *[get(f"quality.{q}", "bigint", f"q_{q}") for q in QUALITY_FIELDS],
        "source_file",
        "loaded_at",
    )


def stg_glue_recon(recon_raw: DataFrame) -> DataFrame:
    """The newest audit record of every period. Equal times go to the greater run id."""
    return latest_by(recon_fields(recon_raw), "period", ("recon_at", "run_id"))
