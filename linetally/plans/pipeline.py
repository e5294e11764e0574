"""The whole run for some periods: convert, load, stage, reconcile, build marts, check."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.env import COMPRESSION, Env, shuffles_removed
from linetally.fixed_values import (
    BATCH,
    DUPLICATE_RATE_EXCEPTIONS,
    DUPLICATE_RATE_LIMIT,
    FRESH_ERROR_DAYS,
    FRESH_WARN_DAYS,
    LINE_TYPES,
    MAPPING_TYPES,
    REVENUE_TOLERANCE,
    SEGMENTS,
    STREAM,
)
from linetally.operators import checks as C
from linetally.plans import marts as M
from linetally.plans.convert import ConversionError, convert_months
from linetally.plans.recon import content_reconciliation, pipeline_reconciliation, require_reconciled, require_same_content, status_report
from linetally.plans.staging import (
    load_recon_raw,
    read_stg,
    refresh_stg_orders,
    stg_entries,
    stg_glue_recon,
    stg_worldbank_countries,
    stg_worldbank_indicators,
)
from linetally.sources import ledger
from linetally.sources.raw_orders import load_periods, raw_entries, read_all_raw, read_raw, read_streamed, stream_entries
from linetally.sources.reference import read_country_mapping

MARTS = (
    "fct_order_lines",
    "fct_orders",
    "fct_revenue_monthly",
    "dim_customer",
    "dim_product",
    "dim_country",
    "dim_date",
)


@dataclass
class RunReport:
    """What a run leaves behind, whether it went through or not."""

    state: str = "FAILED"
    failed_step: str | None = None
    error: Exception | None = None
    steps: list[str] = field(default_factory=list)
    recon: DataFrame | None = None
    # what is known of the periods when no reconciliation could be made
    known: DataFrame | None = None

    def table(self) -> DataFrame | None:
        """Reconciliation per period; after an early failure what is known of each asked period."""
        return self.known if self.recon is None else status_report(self.recon)


def reconciliation(spark: SparkSession, env: Env) -> DataFrame:
    glue = stg_glue_recon(spark.read.parquet(env.recon_raw))
    raw, streamed = read_raw(spark, env.raw_orders), read_streamed(spark, env.raw_orders_stream)
    return pipeline_reconciliation(glue, raw, read_stg(spark, env.stg_orders), streamed)


def contents(spark: SparkSession, env: Env) -> DataFrame:
    """Content compared from the staged files to staging, by the ledgers written with each step.

    A conversion has compared its lines with the files read back, and stops if they differ.
    """
    files = ledger.entries(spark, env.staged)
    return content_reconciliation(
        files, files, raw_entries(spark, env.raw_orders), stg_entries(spark, env.stg_orders), stream_entries(spark, env.raw_orders_stream)
    )


def known_so_far(spark: SparkSession, wanted: list[str], error: Exception) -> DataFrame:
    """The report's columns for the asked periods after a failure before the reconciliation."""
    asked = spark.createDataFrame([(p,) for p in wanted], "period string")
    count = F.lit(None).cast("bigint")
    if isinstance(error, ConversionError):
        rows = asked.join(error.recon.select("period", "source_lines", "rows_written_back", "status"), "period", "left")
    else:
        rows = asked.select("period", count.alias("source_lines"), count.alias("rows_written_back"), F.lit("not_reconciled").alias("status"))
    return rows.select(
        "period",
        F.col("source_lines").alias("ndjson_source_lines"),
        F.col("rows_written_back").alias("glue_wrote_to_s3"),
        *[count.alias(c) for c in ("snowflake_loaded", "dbt_staging_rows", "s3_to_snowflake_diff", "snowflake_to_staging_diff")],
        F.col("status").alias("recon_status"),
    ).orderBy("period")


def store_mart(df: DataFrame, path: str) -> None:
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)


def build_marts(spark: SparkSession, env: Env) -> None:
    """Rebuild every mart. Order lines are stored first and feed all the others."""

    def store(name: str, df: DataFrame) -> DataFrame:
        store_mart(df, env.mart(name))
        return spark.read.schema(df.schema).parquet(env.mart(name))

    lines = store("fct_order_lines", M.fct_order_lines(read_stg(spark, env.stg_orders)))
    orders = store("fct_orders", M.fct_orders(lines))
    store("fct_revenue_monthly", M.fct_revenue_monthly(orders))
    store("dim_customer", M.dim_customer(lines))
    store("dim_product", M.dim_product(lines))
    countries = stg_worldbank_countries(spark.read.parquet(env.raw_countries))
    indicators = stg_worldbank_indicators(spark.read.parquet(env.raw_indicators))
    mapping = read_country_mapping(spark, env.country_mapping)
    store("dim_country", M.dim_country(mapping, countries, indicators, lines))
    store("dim_date", M.dim_date(spark))


def read_marts(spark: SparkSession, env: Env) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(env.mart(name)) for name in MARTS}


def row_checks() -> dict[str, list[C.RowCheck]]:
    """The declared row checks, by table. Each table is scanned once for all of its own."""
    sources = (BATCH, STREAM)
    nn = C.not_null
    return {
        "raw_orders": [
            *map(nn, ("invoice_no", "stock_code", "quantity", "invoice_date", "unit_price", "country")),
            *map(nn, ("source_system", "partition_year", "partition_month", "source_file")),
            C.accepted_values("source_system", sources),
        ],
        "stg_orders": [
            *map(nn, ("invoice_no", "period", "line_type", "is_cancellation", "line_amount", "duplicate_occurrence")),
            C.accepted_values("line_type", LINE_TYPES),
            C.accepted_values("source_system", sources),
            C.expression_is_true(
                "quantity < 0", F.col("quantity") < 0, where=F.col("is_cancellation"), severity="warn"
            ),
        ],
        "fct_order_lines": [*map(nn, ("invoice_no", "stock_code", "line_amount"))],
        "fct_orders": [nn("invoice_no"), C.expression_is_true("line_item_count > 0", F.col("line_item_count") > 0)],
        "fct_revenue_monthly": [nn("total_revenue"), C.accepted_range("total_revenue", low=0)],
        "dim_customer": [
            *map(nn, ("customer_id", "total_orders", "total_revenue")),
            C.accepted_range("cancellation_rate", 0, 1),
            C.accepted_values("customer_segment", tuple(SEGMENTS.values())),
        ],
        "dim_product": [nn("stock_code"), C.accepted_range("avg_unit_price", low=0, where=F.col("stock_code") != "B")],
        "dim_country": [nn("retail_country"), C.accepted_values("mapping_type", MAPPING_TYPES)],
        "dim_date": [nn("date_day")],
        "fct_pipeline_reconciliation": [
            nn("period"),
            C.accepted_values("recon_status", ("ok",)),
            C.accepted_range("s3_to_snowflake_diff", 0, 0),
            C.accepted_range("snowflake_to_staging_diff", 0, 0),
        ],
        "raw_worldbank_countries": [nn("country_id"), nn("country_name")],
        "raw_worldbank_indicators": [
            nn("indicator_id"),
            C.accepted_values("indicator_id", ("NY.GDP.MKTP.CD", "SP.POP.TOTL")),
        ],
        "stg_worldbank_countries": [*map(nn, ("country_id", "country_name", "region_name"))],
        "stg_worldbank_indicators": [nn("country_id"), nn("year")],
        "country_mapping": [
            nn("retail_country"),
            nn("mapping_type"),
            C.accepted_values("mapping_type", MAPPING_TYPES),
        ],
        "stg_glue_recon": [nn("period")],
        "glue_recon_raw": [nn("recon_record")],
    }


# keys that may not repeat, by table
UNIQUE_KEYS = {
    "fct_orders": ("invoice_no",),
    "fct_revenue_monthly": ("period", "country"),
    "dim_customer": ("customer_id",),
    "dim_product": ("stock_code",),
    "dim_country": ("retail_country",),
    "dim_date": ("date_day",),
    "fct_pipeline_reconciliation": ("period",),
    "raw_worldbank_countries": ("country_id",),
    "stg_worldbank_countries": ("country_id",),
    "stg_worldbank_indicators": ("country_id", "year"),
    "country_mapping": ("retail_country",),
    "stg_glue_recon": ("period",),
}


def require_tables(tables: Mapping[str, DataFrame]) -> None:
    """Raise when a table with declared checks is not there: its checks would pass unseen."""
    absent = sorted({*row_checks(), *UNIQUE_KEYS} - tables.keys())
    if absent:
        raise LookupError(f"declared checks without a table: {absent}")


def declared_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared check with the number of violations; each table is scanned once for its row checks."""
    require_tables(tables)
    parts = [C.count_violations(tables[name], name, checks) for name, checks in row_checks().items()]
    for name, key in UNIQUE_KEYS.items():
        repeated = C.not_unique(tables[name], key).agg(F.count(F.lit(1)).alias("violations"))
        labels = {"table_name": name, "check_name": f"unique({', '.join(key)})", "severity": "error"}
        parts.append(repeated.select(*[F.lit(v).alias(k) for k, v in labels.items()], "violations"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def check_marts(spark: SparkSession, env: Env) -> C.Findings:
    """All checks on RAW, staging, reference data, records and marts.

    Every check runs; what fails is raised together, and warnings come back with the findings.
    """
    from linetally.plans.catalog import tables as all_tables

    tables = all_tables(spark, env)
    require_tables(tables)
    lines, stg, mapping, raw = (tables[t] for t in ("fct_order_lines", "stg_orders", "country_mapping", "raw_orders"))
    findings = C.Findings()
    for name, row_check_list in row_checks().items():
        findings.add_counts(C.count_violations(tables[name], name, row_check_list))
    for name, key in UNIQUE_KEYS.items():
        findings.add(C.not_unique(tables[name], key), f"unique {name}{key}")
    streamed = read_streamed(spark, env.raw_orders_stream)
    fresh = C.freshness(raw, datetime.now(timezone.utc), FRESH_WARN_DAYS, FRESH_ERROR_DAYS)
    errors = {
        "staging against the audit record": C.staging_differs_from_recon(stg, tables["stg_glue_recon"], streamed),
        "lines without customer": C.orphans(lines, "customer_id", tables["dim_customer"], "customer_id"),
        "lines without country": C.orphans(lines, "country", tables["dim_country"], "retail_country"),
        "unmapped countries": C.unmapped_countries(stg, mapping),
        "mixed cancellation flags": C.mixed_cancellation_flags(lines),
        "mart rows": C.marts_rows_differ(stg, lines, strict=True),
        "mart revenue": C.marts_revenue_differs(stg, lines, REVENUE_TOLERANCE, strict=True),
    }
    warnings = {
        "unresolved mappings": C.unresolved_mappings(mapping, tables["stg_worldbank_countries"]),
        "periods from several files": C.several_files_per_period(raw),
        "freshness of RAW": fresh.where("state <> 'pass'"),
        "duplicate rate": C.duplicate_rate_outside(stg, DUPLICATE_RATE_LIMIT, DUPLICATE_RATE_EXCEPTIONS),
    }
    for name, violations in errors.items():
        findings.add(violations, name)
    for name, violations in warnings.items():
        findings.add(violations, name, "warn")
    findings.require_none()
    return findings


def run(
    spark: SparkSession,
    env: Env,
    periods: Iterable[str],
    loaded_at: datetime | None = None,
    raise_on_failure: bool = True,
    **convert_options,
) -> RunReport:
    """Process the given periods end to end.

    The marts are not touched unless every period reconciles. The report is
    made either way, so a stopped run shows which hop disagreed.
    """
    wanted, report = list(periods), RunReport()

    def stage() -> None:
        # a rebuilt period keeps the lines that came as a stream
        raw = read_all_raw(spark, env.raw_orders, env.raw_orders_stream)
        refresh_stg_orders(spark, raw, env.stg_orders, wanted)

    def gate() -> None:
        report.recon = reconciliation(spark, env)
        require_reconciled(report.recon, wanted)
        require_same_content(contents(spark, env), wanted)

    steps = {
        "convert": lambda: convert_months(
            spark, env.landing, env.staged, env.audit, wanted, quarantine=env.quarantine, **convert_options
        ),
        "load_raw": lambda: load_periods(spark, env.staged, env.raw_orders, wanted, loaded_at),
        # audit records are loaded before they are compared, never left stale
        "load_audit": lambda: load_recon_raw(spark, env.audit, env.recon_raw, loaded_at),
        "staging": stage,
        "gate": gate,
        "marts": lambda: build_marts(spark, env),
        "checks": lambda: check_marts(spark, env),
    }
    for name, step in steps.items():
        try:
            step()
        except Exception as error:
            report.failed_step, report.error = name, error
            if report.recon is None:
                report.known = known_so_far(spark, wanted, error)
            if raise_on_failure:
                raise
            return report
        report.steps.append(name)
    report.state = "SUCCESS"
    return report
