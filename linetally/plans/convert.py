"""Landed lines to staged monthly Parquet, with every line accounted for."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from linetally.env import forget, written
from linetally.functions.columns import QUALITY_FIELDS, ORDER_COLUMNS, period_key, raw_order_quality
from linetally.schemas import STAGED_ORDER
from linetally.sources import ledger
from linetally.sources.files import drop_partition, existing, write_periods
from linetally.sources.landing import good, parse_lines, read_lines

log = logging.getLogger(__name__)


class ConversionError(ValueError):
    """At least one period was refused or does not balance. ``recon`` holds all periods."""

    def __init__(self, message: str, recon: DataFrame):
        super().__init__(message)
        self.recon = recon


def period_range(start: str, end: str) -> list[str]:
    """Periods from start to end, both included."""
    first, last = (int(p[:4]) * 12 + int(p[5:7]) - 1 for p in (start, end))
    if last < first:
        raise ValueError(f"end period {end} is before start period {start}")
    return [f"{n // 12:04d}-{n % 12 + 1:02d}" for n in range(first, last + 1)]


def period_metrics(parsed: DataFrame) -> DataFrame:
    """All counts of a conversion per landed period, in one aggregate.

    source_lines counts text lines; blank lines are in it but in none of the
    other counts, so they show up as an imbalance.
    """
    is_good = ~F.col("is_blank") & ~F.col("is_corrupt")
    own = F.date_format("invoice_date", "yyyy-MM")
    undated = is_good & F.col("invoice_date").isNull()
    counted = parsed.withColumn("is_good", is_good)
    counts = [
        F.count(F.lit(1)).alias("source_lines"),
        F.count_if("is_corrupt").alias("corrupt_rows"),
        F.count_if(undated).alias("undated_rows"),
        F.count_if(is_good & F.coalesce(own != F.col("path_period"), F.lit(False))).alias("stray_rows"),
    ]
    quality = [
        F.count_if("is_good").alias("rows_total"),
        F.count_if(is_good & F.col("invoice_no").isNull()).alias("null_invoice_no"),
        F.count_if(is_good & F.col("customer_id").isNull()).alias("null_customer_id"),
        F.count_if(is_good & (F.col("quantity") < 0)).alias("negative_quantity"),
        F.count_if(is_good & (F.col("unit_price") <= 0)).alias("non_positive_price"),
        F.count_if(is_good & F.startswith("invoice_no", F.lit("C"))).alias("cancellations"),
        F.count_if(undated).alias("unparseable_date"),
    ]
    lines = ledger.line_sums(is_good & F.col("invoice_date").isNotNull())
    return counted.groupBy("path_period").agg(*counts, *quality, *lines).withColumnRenamed("path_period", "period")


def quality_metrics(parsed: DataFrame) -> DataFrame:
    """The seven observed counts over all good lines; zeros on an empty input."""
    return good(parsed).agg(*raw_order_quality())


def set_aside(parsed: DataFrame) -> DataFrame:
    """Corrupt and undated lines with the reason and their text."""
    return parsed.where(F.col("line").isNotNull()).select(
        F.col("path_period").alias("period"),
        F.when(F.col("is_corrupt"), "corrupt").otherwise("undated").alias("reason"),
        "line",
    )


def replace_quarantine(aside: DataFrame, quarantine: str, periods: Iterable[str]) -> None:
    """Set lines aside by period; what an earlier run set aside for these periods goes, also where none is left."""
    spark = aside.sparkSession
    held = {r["period"] for r in aside.select("period").distinct().collect()}  # one row per period
    if held:
        write_periods(aside, quarantine, ("period",), fmt="json")
    for period in set(periods) - held:
        drop_partition(spark, f"{quarantine}/period={period}")


def staged_counts(spark: SparkSession, staged: str, periods: list[str]) -> DataFrame:
    """Rows, bytes and fingerprint per period, read back from what was written."""
    schema = StructType([*STAGED_ORDER.fields, StructField("year", IntegerType()), StructField("month", IntegerType())])
    # only the folders of these periods are listed
    names = [f"{staged}/year={int(p[:4])}/month={int(p[5:7])}" for p in periods]
    folders = existing(spark, names)
    rows = spark.read.schema(schema).option("basePath", staged).parquet(*folders) if folders else None
    if rows is None:
        sums = ", ".join(f"{c} bigint" for c in ledger.RAW_SUMS)
        return spark.createDataFrame([], f"period string, rows_written_back bigint, output_bytes bigint, {sums}")
    files = (
        rows
        .groupBy("year", "month", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("bytes"))
        .agg(F.count(F.lit(1)).alias("n"), *ledger.line_sums())
    )
    return files.groupBy(period_key("year", "month").alias("period")).agg(
        F.sum("n").alias("rows_written_back"), F.sum("bytes").alias("output_bytes"), *[F.sum(c).alias(c) for c in ledger.RAW_SUMS]
    )


def _status(expected: Column) -> Column:
    return (
        F.when(F.col("source_lines") == 0, "no_source_lines")
        .when(F.col("stray_rows") > 0, "stray_rows")
        .when(F.col("rows_written_back") != expected, "unbalanced")
        .when(~F.col("content_same"), "content_differs")
        .otherwise("converted")
    )


def convert_months(
    spark: SparkSession,
    landing: str,
    staged: str,
    audit: str,
    periods: Iterable[str],
    *,
    job_name: str = "json-to-parquet",
    run_id: str | None = None,
    fail_on_mismatch: bool = True,
    quarantine: str | None = None,
) -> DataFrame:
    """Convert any number of months in one run and return a row per period.

    The landing zone is read once: lines are counted, parsed and written to a
    columnar scratch table, and the guards, the staged write and the audit all
    read that. A period with stray lines is refused before anything of it is
    written, since it would overwrite another month. The other periods go on;
    what failed is raised together at the end, after the audit is stored.
    An imbalance only warns when ``fail_on_mismatch`` is off.
    """
    began = time.monotonic()
    wanted = list(periods)
    run_id = run_id or uuid.uuid4().hex
    parsed = written(parse_lines(read_lines(spark, landing, wanted)), "parsed")

    # from here on only per-period rows reach the driver
    metrics = written(period_metrics(parsed), "metrics")
    clean = [r["period"] for r in metrics.where("stray_rows = 0").select("period").collect()]
    rows = good(parsed).where(F.col("path_period").isin(clean) & F.col("invoice_date").isNotNull())
    ledger.strike(spark, staged, clean)
    write_periods(rows.select(*ORDER_COLUMNS, "year", "month"), staged, ("year", "month"))
    # a dynamic overwrite leaves the folder of a period that has no good row any more
    for r in metrics.where("stray_rows = 0 AND rows_total = undated_rows").select("period").collect():
        drop_partition(spark, f"{staged}/year={int(r['period'][:4])}/month={int(r['period'][5:7])}")
    if quarantine:
        replace_quarantine(set_aside(parsed.where(F.col("path_period").isin(clean))), quarantine, clean)

    back = staged_counts(spark, staged, clean)
    expected = F.col("source_lines") - F.col("corrupt_rows") - F.col("undated_rows")
    asked = spark.createDataFrame([(p,) for p in wanted], "period string")
    back_sums = [f"back_{c}" for c in ledger.RAW_SUMS]
    same = F.lit(True)
    for c, b in zip(ledger.RAW_SUMS, back_sums, strict=True):
        same = same & (F.coalesce(c, F.lit(0)) == F.coalesce(b, F.lit(0)))
    back = written(back.withColumnsRenamed(dict(zip(ledger.RAW_SUMS, back_sums, strict=True))), "read-back")
    counts = (
        asked.join(metrics, "period", "left")
        .join(back, "period", "left")
        .withColumn("content_same", same)
        .na.fill(0, ["source_lines", "corrupt_rows", "undated_rows", "stray_rows", "rows_written_back", "output_bytes"])
    )
    recon = written(
        counts.select(
            F.lit(run_id).alias("run_id"),
            F.lit(job_name).alias("job_name"),
            "period",
            F.concat(F.lit(f"{landing}/event_date="), "period", F.lit("-*/*.json")).alias("input_path"),
            F.concat(
                F.lit(f"{staged}/year="),
                F.substring("period", 1, 4),
                F.lit("/month="),
                F.substring("period", 6, 2).cast("int").cast("string"),
            ).alias("output_partition"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("recon_at"),
            "source_lines",
            "corrupt_rows",
            "undated_rows",
            expected.alias("expected_rows"),
            "rows_written_back",
            (F.col("rows_written_back") - expected).alias("difference"),
            (F.col("rows_written_back") == expected).alias("balanced"),
            F.struct(*[F.coalesce(q, F.lit(0)).alias(q) for q in QUALITY_FIELDS]).alias("quality"),
            "output_bytes",
            F.lit(round(time.monotonic() - began, 3)).alias("job_run_seconds"),
            "stray_rows",
            _status(expected).alias("status"),
        ),
        "recon",
    )
    write_audit(recon.where(F.col("status").isin("converted", "unbalanced", "content_differs")), audit)
    # the ledger of the staged files: what was read back, by period
    held = back.select("period", F.col("rows_written_back").alias("n"), F.lit(None).cast("timestamp").alias("newest"), *[F.col(b).alias(c) for b, c in zip(back_sums, ledger.RAW_SUMS, strict=True)], *[F.lit(None).cast("bigint").alias(c) for c in ledger.CLEAN_SUMS])
    ledger.enter(held, staged)
    for scratch in (parsed, metrics, back):
        forget(scratch)

    failed = recon.where("status <> 'converted'").orderBy("period").collect()  # one row per period
    fatal = [r for r in failed if fail_on_mismatch or r["status"] != "unbalanced"]
    for r in failed:
        log.warning("period %s: %s, expected %s, found %s", r["period"], r["status"], r["expected_rows"], r["rows_written_back"])
    if fatal:
        raise ConversionError(
            "; ".join(
                f"{r['period']}: {r['status']} (lines {r['source_lines']}, corrupt {r['corrupt_rows']}, "
                f"undated {r['undated_rows']}, stray {r['stray_rows']}, written {r['rows_written_back']})"
                for r in fatal
            ),
            recon,
        )
    return recon


def convert_month(spark: SparkSession, landing: str, staged: str, audit: str, period: str, **options) -> DataFrame:
    """Convert one period."""
    return convert_months(spark, landing, staged, audit, [period], **options)


def backfill(spark: SparkSession, landing: str, staged: str, audit: str, start: str, end: str, **options) -> DataFrame:
    """Convert every period from ``start`` to ``end``; failed ones do not stop the others."""
    return convert_months(spark, landing, staged, audit, period_range(start, end), **options)


AUDIT_FIELDS = (
    "run_id",
    "job_name",
    "period",
    "input_path",
    "output_partition",
    "recon_at",
    "source_lines",
    "corrupt_rows",
    "undated_rows",
    "expected_rows",
    "rows_written_back",
    "difference",
    "balanced",
    "quality",
    "output_bytes",
    "job_run_seconds",
)


def write_audit(recon: DataFrame, audit: str) -> None:
    """One JSON record per run and period below ``job=/period=/run=``.

    Earlier runs stay. Storing the same run twice replaces its record.
    """
    fields = [c for c in AUDIT_FIELDS if c in recon.columns]
    record = F.to_json(F.struct(*fields), {"pretty": "true", "ignoreNullFields": "false"})
    recon.select(
        record.alias("value"),
        F.col("job_name").alias("job"),
        "period",
        F.col("run_id").alias("run"),
    ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job", "period", "run").text(audit)
