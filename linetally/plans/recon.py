"""Row counts compared at every hop, the gate on them, and the status report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linetally.functions.columns import period_key, ratio
from linetally.plans.staging import recon_fields
from linetally.sources.ledger import CLEAN_SUMS, RAW_SUMS, added_up, same_content


class ReconciliationError(ValueError):
    """A period may not go on to the marts."""


def _per_period(df: DataFrame, period, out: str) -> DataFrame:
    return df.groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias(out))


def raw_counts(raw: DataFrame) -> DataFrame:
    # only partition columns are read, so this scans no row data
    return _per_period(raw, period_key("partition_year", "partition_month"), "rows_in_raw")


def staging_counts(stg: DataFrame) -> DataFrame:
    return _per_period(stg, F.col("period"), "rows_in_staging")


def pipeline_reconciliation(
    glue: DataFrame, raw: DataFrame, stg: DataFrame, streamed: DataFrame | None = None
) -> DataFrame:
    """One row per period seen anywhere, with a status naming the hop that disagrees.

    All sides are already one row per period when they are joined. The first
    matching status wins, and a NULL count or flag does not match. Streamed
    lines reach staging beside RAW, so they are counted out of it.
    """
    g = glue.select(F.lit(True).alias("has_record"), *glue.columns)
    r = raw_counts(raw).withColumn("has_raw", F.lit(True))
    # join(using) coalesces the key, so the second join sees periods of either side
    s = staging_counts(stg)
    if streamed is not None:
        beside = raw_counts(streamed).withColumnRenamed("rows_in_raw", "rows_streamed")
        s = s.join(beside, "period", "full").select(
            "period",
            (F.coalesce("rows_in_staging", F.lit(0)) - F.coalesce("rows_streamed", F.lit(0))).alias("rows_in_staging"),
        )
    sides = g.join(r, "period", "full").join(s, "period", "full")
    in_raw = F.coalesce("rows_in_raw", F.lit(0))
    in_stg = F.coalesce("rows_in_staging", F.lit(0))
    status = (
        F.when(F.col("has_record").isNull(), "no_glue_record")
        .when(F.col("has_raw").isNull(), "not_loaded_to_snowflake")
        .when(~F.col("glue_balanced"), "glue_unbalanced")
        .when(in_raw != F.col("rows_written_back"), "s3_to_snowflake_mismatch")
        .when(in_stg != F.col("rows_in_raw"), "snowflake_to_staging_mismatch")
        .otherwise("ok")
    )
    return sides.select(
        "period",
        F.col("source_lines").alias("ndjson_source_lines"),
        "corrupt_rows",
        "undated_rows",
        F.col("rows_written_back").alias("glue_wrote_to_s3"),
        F.col("rows_in_raw").alias("snowflake_loaded"),
        F.col("rows_in_staging").alias("dbt_staging_rows"),
        (in_raw - F.coalesce("rows_written_back", F.lit(0))).alias("s3_to_snowflake_diff"),
        (in_stg - in_raw).alias("snowflake_to_staging_diff"),
        "glue_balanced",
        F.col("recon_at").alias("last_glue_run_at"),
        F.col("run_id").alias("last_glue_run_id"),
        status.alias("recon_status"),
    )


def content_reconciliation(lines: DataFrame, staged: DataFrame, raw: DataFrame, stg: DataFrame, streamed: DataFrame | None = None) -> DataFrame:
    """Content compared at every hop, by ledger entries (:mod:`linetally.sources.ledger`) of each side.

    Equal counts do not show rows that were exchanged; fingerprints do. ``raw`` and ``streamed`` together are what staging
    holds. One row per period with a status naming the first hop that disagrees.
    """
    sides = {"l": lines, "f": staged, "r": raw, "a": raw if streamed is None else added_up(raw, streamed), "s": stg}
    periods = None
    for side in sides.values():
        periods = side.select("period") if periods is None else periods.union(side.select("period"))
    joined = periods.distinct().alias("p")
    for name, side in sides.items():
        joined = joined.join(side.alias(name), F.col("p.period") == F.col(f"{name}.period"), "left")

    def differ(sums: tuple[str, ...], left: str, right: str):
        rows = F.coalesce(f"{left}.n", F.lit(0)) != F.coalesce(f"{right}.n", F.lit(0))
        return rows | ~same_content(sums, left, right)

    status = (
        F.when(differ(RAW_SUMS, "l", "f"), "lines_to_staged_differ")
        .when(differ(RAW_SUMS, "f", "r"), "staged_to_raw_differ")
        .when(differ(CLEAN_SUMS, "a", "s"), "raw_to_staging_differ")
        .otherwise("ok")
    )
    counts = {"rows_in_lines": "l", "rows_in_files": "f", "rows_in_raw": "r", "rows_in_staging": "s"}
    return joined.select("p.period", *[F.coalesce(f"{side}.n", F.lit(0)).alias(c) for c, side in counts.items()], status.alias("content_status"))


def require_same_content(recon: DataFrame, periods: list[str]) -> None:
    """Raise unless the content of every given period is the same at every hop."""
    bad = recon.where((F.col("content_status") != "ok") & F.col("period").isin(periods)).orderBy("period").collect()
    if bad:
        raise ReconciliationError("; ".join(f"{r['period']}: {r['content_status']}" for r in bad))


def gate_findings(recon: DataFrame, periods: list[str] | None = None) -> DataFrame:
    """Why each period would be stopped; no row means it may pass.

    A period without a record is stopped, and so is one whose status reads
    ``ok`` only because a count or the balance flag is NULL.
    """
    unknown = F.col("glue_wrote_to_s3").isNull() | F.col("glue_balanced").isNull()
    reason = F.when(F.col("recon_status") != "ok", F.col("recon_status")).when(unknown, "unknown_counts")
    rows = recon
    if periods is not None:
        asked = recon.sparkSession.createDataFrame([(p,) for p in periods], "period string")
        rows = asked.join(recon, "period", "left")
        reason = F.when(F.col("recon_status").isNull(), "no_reconciliation_row").otherwise(reason)
    return rows.select("period", reason.alias("reason")).where(F.col("reason").isNotNull())


def require_reconciled(recon: DataFrame, periods: list[str]) -> None:
    """The gate: raise unless every given period is reconciled."""
    stopped = gate_findings(recon, periods).orderBy("period").collect()  # one row per period
    if stopped:
        raise ReconciliationError("; ".join(f"{r['period']}: {r['reason']}" for r in stopped))


def status_report(recon: DataFrame) -> DataFrame:
    """The table an operator reads after a run, in period order."""
    return recon.select(
        "period",
        "ndjson_source_lines",
        "glue_wrote_to_s3",
        "snowflake_loaded",
        "dbt_staging_rows",
        "s3_to_snowflake_diff",
        "snowflake_to_staging_diff",
        "recon_status",
    ).orderBy("period")


def overall_state(recon: DataFrame) -> str:
    return "FAILED" if recon.where("recon_status <> 'ok'").limit(1).count() else "SUCCESS"


def recon_vs_loaded(recon_raw: DataFrame, raw: DataFrame) -> DataFrame:
    """Every audit record, older ones too, against what RAW holds for its period."""
    records = recon_fields(recon_raw).select("period", "run_id", F.col("rows_written_back").alias("glue_wrote"))
    return (
        records.join(raw_counts(raw), "period", "left")
        .withColumn("difference", F.col("rows_in_raw") - F.col("glue_wrote"))
        .withColumnRenamed("rows_in_raw", "rows_loaded")
    )


def volume_anomaly(stg: DataFrame, window: int = 3) -> DataFrame:
    """Rows per period against the average of the ``window`` periods before it."""
    # one row per period: a window over all of them is small whatever the data
    before = Window.orderBy("period").rowsBetween(-window, -1)
    prior = ratio(F.sum("rows_in_staging").over(before), F.count("rows_in_staging").over(before))
    return (
        staging_counts(stg)
        .withColumn("prior_average", prior)
        .withColumn("volume_ratio", ratio(F.col("rows_in_staging"), F.col("prior_average")))
    )
