"""The source CSV: scan, preparation, profile, hold-back and daily files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from linetally.env import written
from linetally.fixed_values import BATCH, CSV_ENCODING, CSV_HEADERS, STREAM
from linetally.functions.columns import is_cancellation, order_time, ratio, whole_number_text
from linetally.operators.aggregates import exact_copies
from linetally.schemas import LANDED_ORDER
from linetally.sources.files import write_periods
from linetally.sources.quoted_csv import records, same_ranges

CSV_COLUMNS = tuple(dict.fromkeys(CSV_HEADERS.values()))


# the text of a row that has another number of fields than the header
MALFORMED = "malformed_row"


def scan_csv_rows(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Order CSV as eight text columns, whichever header spelling it uses, and ``malformed_row``.

    Only the header line is looked at before the scan; nothing is inferred.
    The file is parsed once, into shared scratch, where profile, landing and
    what is set aside read it. Quoted fields may hold line breaks, and the file is read by ranges all the same
    (:mod:`linetally.sources.quoted_csv`). For files known to hold none, ``multi_line=False`` saves the shuffle of lines.
    """
    dialect = {"encoding": CSV_ENCODING, "escape": '"'}
    reader = spark.read.options(header="true", **dialect)
    found = reader.csv(path).columns
    names = [CSV_HEADERS.get(c, c) for c in found]
    missing = [c for c in CSV_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"CSV lacks columns {missing}; it has {found}")
    schema = StructType([StructField(c, StringType()) for c in (*found, MALFORMED)])
    with same_ranges(spark):
        if multi_line:
            options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
            fields = F.from_csv("record", ", ".join(f"`{c}` string" for c in schema.fieldNames()), options).alias("fields")
            lines = records(spark, path, CSV_ENCODING).select(fields, "record", "whole").select(
                *[F.col(f"fields.`{c}`") for c in found],
                F.when(F.col("whole"), F.col(f"fields.{MALFORMED}")).otherwise(F.col("record")).alias(MALFORMED),
            )
        else:
            lines = reader.schema(schema).option("columnNameOfCorruptRecord", MALFORMED).csv(path)
        lines = lines.withColumnsRenamed(dict(zip(found, names, strict=True))).select(*CSV_COLUMNS, MALFORMED)
        return written(lines, "source-csv")


def well_formed(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(MALFORMED).isNull()).select(*CSV_COLUMNS)


def malformed_rows(rows: DataFrame) -> DataFrame:
    """Text of the rows whose fields do not match the header; they are set aside and counted."""
    return rows.where(F.col(MALFORMED).isNotNull()).select(F.lit("malformed").alias("reason"), F.col(MALFORMED).alias("line"))


def scan_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The well-formed rows of an order CSV."""
    return well_formed(scan_csv_rows(spark, path, multi_line))


def require_dated(dated: int, undated: int, most: float) -> None:
    """Raise when more than the stated share of rows has no usable date."""
    if undated > most * (dated + undated):
        raise ValueError(f"{undated} of {dated + undated} rows have no usable date; at most {most:.0%} may")


def prepare(lines: DataFrame) -> DataFrame:
    """Typed lines with an event date. Undated lines are kept; see :func:`split_undated`."""
    return lines.select(
        "invoice_no",
        "stock_code",
        "description",
        F.col("quantity").try_cast("int").alias("quantity"),
        order_time("invoice_date").alias("invoice_date"),
        F.col("unit_price").try_cast("double").alias("unit_price"),
        whole_number_text("customer_id").alias("customer_id"),
        "country",
        F.lit(BATCH).alias("source_system"),
    ).withColumn("event_date", F.col("invoice_date").cast("date"))


def split_undated(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dated, undated): only dated lines can be filed under a day."""
    return (
        prepared.where(F.col("invoice_date").isNotNull()),
        prepared.where(F.col("invoice_date").isNull()),
    )


def profile(dated: DataFrame) -> DataFrame:
    """One row describing how messy the source is, from one scan.

    Lines are folded to distinct lines with a copy count, then to (invoice,
    customer, country). Both combine before their shuffle, and only the folded
    rows are expanded for the three distinct counts.
    """
    copies = F.col("copies")

    def rows_where(condition):
        return F.sum(F.when(condition, copies).otherwise(F.lit(0)))

    folded = (
        exact_copies(dated, CSV_COLUMNS)
        .groupBy("invoice_no", "customer_id", "country")
        .agg(
            F.sum(copies).alias("row_count"),
            F.min("invoice_date").alias("first_date"),
            F.max("invoice_date").alias("last_date"),
            rows_where(F.col("quantity") < 0).alias("negative_quantity"),
            rows_where(F.col("unit_price") <= 0).alias("non_positive_price"),
            F.sum(copies - 1).alias("exact_duplicates"),
        )
    )

    def total(column):
        return F.coalesce(F.sum(column), F.lit(0))

    rows = F.col("row_count")
    return folded.agg(
        total(rows).alias("row_count"),
        F.min("first_date").cast("date").alias("first_date"),
        F.max("last_date").cast("date").alias("last_date"),
        F.count_distinct("invoice_no").alias("distinct_invoices"),
        F.count_distinct("customer_id").alias("distinct_customers"),
        F.count_distinct("country").alias("distinct_countries"),
        total(F.when(F.col("customer_id").isNull(), rows)).alias("null_customer_id"),
        total("negative_quantity").alias("negative_quantity"),
        total("non_positive_price").alias("non_positive_price"),
        total(F.when(is_cancellation("invoice_no"), rows)).alias("cancellations"),
        total("exact_duplicates").alias("exact_duplicates"),
    ).withColumn("null_customer_share", ratio(F.col("null_customer_id"), rows))


def stream_cutoff(dated: DataFrame, days: int):
    """The ``days``-th latest distinct event date."""
    latest = dated.select("event_date").distinct().orderBy(F.col("event_date").desc()).limit(days)
    row = latest.agg(F.min("event_date").alias("cutoff"), F.count(F.lit(1)).alias("found")).first()
    if days < 1 or row["found"] < days:
        raise ValueError(f"cannot hold back {days} days: the data has {row['found']}")
    return row["cutoff"]


def hold_back(dated: DataFrame, days: int) -> tuple[DataFrame, DataFrame]:
    """(batch, stream): the last ``days`` distinct days are kept for replay."""
    cutoff = stream_cutoff(dated, days)
    return (
        dated.where(F.col("event_date") < F.lit(cutoff)),
        dated.where(F.col("event_date") >= F.lit(cutoff)).withColumn("source_system", F.lit(STREAM)),
    )


def landed_form(lines: DataFrame) -> DataFrame:
    """Lines as they are written to the landing zone: ISO text for both times."""
    out = lines.withColumn("invoice_date", F.date_format("invoice_date", "yyyy-MM-dd'T'HH:mm:ss"))
    if "ingested_at" not in lines.columns:
        out = out.withColumn("ingested_at", F.current_timestamp())
    stamp = F.date_format(F.to_utc_timestamp("ingested_at", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return out.withColumn("ingested_at", F.concat(stamp, F.lit("+00:00"))).select(*LANDED_ORDER.fieldNames(), "event_date")


def write_daily(lines: DataFrame, root: str) -> None:
    """One folder of newline-delimited JSON per event date; rerunning replaces the days."""
    write_periods(landed_form(lines), root, ("event_date",), fmt="json")
