"""RAW.ORDERS: staged Parquet files to the typed, uncleaned replay table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.env import forget, written
from linetally.functions.columns import path_number
from linetally.schemas import RAW_ORDER, STAGED_ORDER
from linetally.sources import ledger, versions
from linetally.sources.files import file_listing, path_exists

STAGED_FILES = "part-*.snappy.parquet"
PARTITION = ("partition_year", "partition_month")


def split_period(period: str) -> tuple[int, int]:
    year, month = period.split("-")
    return int(year), int(month)


def in_periods(periods: Iterable[str]) -> Column:
    """Periods as one predicate on the RAW partition columns, so folders are pruned."""
    wanted = [year * 100 + month for year, month in map(split_period, periods)]
    return (F.col("partition_year") * 100 + F.col("partition_month")).isin(wanted)


def read_raw(spark: SparkSession, raw: str) -> DataFrame:
    """RAW as it is now; a load that ends later does not change what this frame reads."""
    return versions.read(spark, raw, RAW_ORDER)


def read_streamed(spark: SparkSession, stream_raw: str) -> DataFrame | None:
    """RAW lines that arrived as a stream; None when none did."""
    if not path_exists(spark, stream_raw):
        return None
    return spark.read.schema(RAW_ORDER).parquet(stream_raw).select(*RAW_ORDER.fieldNames())


def read_all_raw(spark: SparkSession, raw: str, stream_raw: str) -> DataFrame:
    """Batch and streamed RAW lines in one frame; ``source_system`` tells them apart."""
    batch, streamed = read_raw(spark, raw), read_streamed(spark, stream_raw)
    return batch if streamed is None else batch.unionByName(streamed)


def raw_entries(spark: SparkSession, raw: str) -> DataFrame:
    """The ledger of RAW. No row of RAW is read but of periods not measured yet."""
    return ledger.brought_up(spark, raw, lambda periods: read_raw(spark, raw).where(in_periods(periods)))


def stream_entries(spark: SparkSession, stream_raw: str) -> DataFrame | None:
    """The ledger of the lines that came as a stream; None when none did."""
    if not path_exists(spark, stream_raw):
        return None
    return raw_entries(spark, stream_raw)


def all_entries(spark: SparkSession, raw: str, stream_raw: str) -> DataFrame:
    """RAW's ledger with that of its stream store."""
    own, beside = raw_entries(spark, raw), stream_entries(spark, stream_raw)
    return own if beside is None else ledger.added_up(own, beside)


def read_staged_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Staged files as RAW rows, without ``loaded_at``.

    They are read as plain files. Year and month come from the file path and
    are NULL when the path does not name them. Empty marker objects do not
    match the file pattern; an unreadable file stops the load.
    """
    return (
        spark.read.schema(STAGED_ORDER)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", STAGED_FILES)
        .option("ignoreCorruptFiles", "false")
        .parquet(*paths)
        .select(*STAGED_ORDER.fieldNames(), F.col("_metadata.file_path").alias("source_file"))
        .withColumn("partition_year", path_number("source_file", "year"))
        .withColumn("partition_month", path_number("source_file", "month"))
    )


def _stamped(rows: DataFrame, loaded_at: datetime | None) -> DataFrame:
    stamp = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    return rows.withColumn("loaded_at", stamp).select(*RAW_ORDER.fieldNames())


def files_to_load(spark: SparkSession, staged: str, raw: str) -> DataFrame:
    """Staged files RAW does not hold yet, with the period in their path.

    The ledger is RAW's own ``source_file`` column, read only for the periods
    that have candidate files: they are in the filter as literals, so other
    folders are pruned.
    """
    found = (
        file_listing(spark, staged, STAGED_FILES)
        .withColumn("partition_year", path_number("source_file", "year"))
        .withColumn("partition_month", path_number("source_file", "month"))
    )
    if not versions.exists(spark, raw):
        return found
    candidates = found.select(*PARTITION).distinct().collect()  # one row per period
    of_candidates = in_periods(f"{r[0]:04d}-{r[1]:02d}" for r in candidates if None not in r)
    if any(None in r for r in candidates):
        of_candidates = of_candidates | F.col("partition_year").isNull() | F.col("partition_month").isNull()
    held = read_raw(spark, raw).where(of_candidates).select(_uri("source_file").alias("uri")).distinct()
    return found.withColumn("uri", _uri("source_file")).join(held, "uri", "left_anti").drop("uri")


def _uri(path: str) -> Column:
    """``file:/x`` and ``file:///x`` name the same file."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def load_new_files(spark: SparkSession, staged: str, raw: str, loaded_at: datetime | None = None) -> int:
    """Load files not loaded before; rows of other files stay. Returns the file count."""
    new = written(files_to_load(spark, staged, raw).select("source_file", *PARTITION), "new-files")
    count = new.count()
    if count:
        # the driver sees folders of periods, never the list of files
        folders = new.select(F.regexp_replace("source_file", "/[^/]+$", "").alias("folder")).distinct()
        paths = [r["folder"] for r in folders.collect()]
        names = new.select(_uri("source_file").alias("uri"))
        rows = read_staged_files(spark, *paths).withColumn("uri", _uri("source_file")).join(names, "uri", "left_semi")
        rows = _stamped(rows, loaded_at)
        touched = {f"{r[0]:04d}-{r[1]:02d}" for r in new.select(*PARTITION).distinct().collect() if None not in r}
        prepared = versions.prepare(rows, raw, PARTITION)
        ledger.strike(spark, raw, touched)
        versions.append(spark, prepared)
        raw_entries(spark, raw)
    forget(new)
    return count


def prepare_periods(
    spark: SparkSession, staged: str, raw: str, periods: Iterable[str], loaded_at: datetime | None = None
) -> versions.Pending | None:
    """Write what is staged for these periods beside RAW, unseen by readers. None if nothing is staged.

    Staged files already belong to one month each, so no shuffle is needed.
    """
    folders = ["{}/year={}/month={}".format(staged, *split_period(p)) for p in periods]
    paths = [f for f in folders if path_exists(spark, f)]
    if not paths:
        return None
    return versions.prepare(_stamped(read_staged_files(spark, *paths), loaded_at), raw, PARTITION)


def load_periods(
    spark: SparkSession,
    staged: str,
    raw: str,
    periods: Iterable[str],
    loaded_at: datetime | None = None,
) -> None:
    """Replace whole periods of RAW with what is staged for them now.

    One switch of the manifest does the delete and the load together, for all
    periods at once: a load that stops leaves every old period whole, and a
    rerun cannot double one. A period with nothing staged is removed.
    """
    periods = list(periods)
    new = prepare_periods(spark, staged, raw, periods, loaded_at)
    ledger.strike(spark, raw, periods)
    gone = ["partition_year={}/partition_month={}".format(*split_period(p)) for p in periods]
    versions.replace(spark, raw, PARTITION, new, gone)
    raw_entries(spark, raw)


def partition_summary(raw: DataFrame) -> DataFrame:
    """Rows and date range per RAW partition."""
    return (
        raw.groupBy(*PARTITION)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("invoice_date").alias("first_invoice_date"),
            F.max("invoice_date").alias("last_invoice_date"),
        )
        .orderBy(*PARTITION)
    )


def null_partition_keys(raw: DataFrame) -> DataFrame:
    """Rows whose path did not yield a year or a month; should be zero."""
    missing = F.col("partition_year").isNull() | F.col("partition_month").isNull()
    return raw.agg(F.count_if(missing).alias("rows_with_null_partition"))
