"""Replaying held-back days as a stream of order lines.

Lines arrive as text files, are parsed exactly as in the batch path, and each
micro-batch writes its own slice of the stream RAW table, its quarantine and
one audit row. Staging is rebuilt once, after the last batch. There is no
watermark: a late line rebuilds its period like any other, since counts have
to balance.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.env import COMPRESSION, forget, shuffles_removed, written
from linetally.functions.columns import period_key
from linetally.plans.staging import refresh_from_ledgers
from linetally.schemas import RAW_ORDER
from linetally.sources import ledger
from linetally.sources.files import path_exists
from linetally.sources.landing import LANDED_FILES, parse_lines
from linetally.sources.raw_orders import PARTITION

STREAM_PARTITION = (*PARTITION, "query_id", "batch_id")

STREAM_AUDIT = (
    "query_id string, batch_id long, recon_at timestamp, source_lines long, blank_rows long, corrupt_rows long, "
    "undated_rows long, stray_rows long, repeated_rows long, rows_written long, difference long, balanced boolean, status string"
)


def stream_lines(spark: SparkSession, folder: str, max_files: int) -> DataFrame:
    """Text lines of newly arrived files, with the period of their folder and their file."""
    return (
        spark.readStream.schema("value string, event_date string")
        .option("pathGlobFilter", LANDED_FILES)
        .option("maxFilesPerTrigger", max_files)
        .text(folder)
        .withColumn("path_period", F.substring("event_date", 1, 7))
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def _store(batch: DataFrame, path: str, partition: tuple[str, ...]) -> None:
    writer = batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition)
    with shuffles_removed(batch.sparkSession):
        writer.option("compression", COMPRESSION).parquet(path)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps with the checkpoint: another checkpoint has another id, a restart has the same."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _files(stream_raw: str, state: str) -> str:
    return f"{stream_raw}/_files/{state}"  # readers of the store pass over it


def _known_files(spark: SparkSession, stream_raw: str, query_id: str, batch_id: int) -> DataFrame | None:
    """Files that another batch has taken in, whatever became of their lines.

    A batch notes its files before it stores anything and again once all is stored. Of a batch that stopped in between,
    and of a store from before there were notes, the files are those with stored rows.
    """
    schema = "source_file string, query_id string, batch_id long"
    other = ~((F.col("query_id") == query_id) & (F.col("batch_id") == batch_id))

    def noted(state: str) -> DataFrame:
        path = _files(stream_raw, state)
        return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)

    if not path_exists(spark, stream_raw):
        return None
    done = noted("done").where(other)
    store = spark.read.schema(schema).parquet(stream_raw).where(other)
    if path_exists(spark, _files(stream_raw, "begun")):
        batches = noted("begun").where(other).select("query_id", "batch_id").distinct()
        stopped = batches.join(done.select("query_id", "batch_id").distinct(), ["query_id", "batch_id"], "left_anti").collect()  # as a rule none
        if not stopped:
            return done.select("source_file").distinct()
        store = store.where(F.array_contains(F.lit([f"{r[0]} {r[1]}" for r in stopped]), F.concat_ws(" ", "query_id", "batch_id")))
    return done.select("source_file").union(store.select("source_file")).distinct()


def _fate() -> Column:
    """What becomes of a parsed line; each line has exactly one fate. A file taken in before is repeated as a whole."""
    own = F.date_format("invoice_date", "yyyy-MM")
    return (
        F.when(F.col("is_held"), "repeated")
        .when(F.col("is_blank"), "blank")
        .when(F.col("is_corrupt"), "corrupt")
        .when(F.col("invoice_date").isNull(), "undated")
        .when(own != F.col("path_period"), "stray")
        .otherwise("written")
    )


def read_stream_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STREAM_AUDIT).parquet(path)


def replay(
    spark: SparkSession,
    folder: str,
    raw: str,
    stream_raw: str,
    stg: str,
    checkpoint: str,
    quarantine: str,
    audit: str,
    max_files: int = 1000,
    loaded_at: datetime | None = None,
) -> list[str]:
    """Take in every file not seen yet, then stop and return the staging periods rebuilt.

    ``foreachBatch`` may run a batch again after a failure. All it writes is
    keyed by query and batch, so a second run replaces the first. A lost
    checkpoint gives a new query, which reads all files again: lines of files
    that another batch took in are counted as repeated, and neither stored nor
    set aside twice. Blank, corrupt, undated and stray lines are set aside; the
    audit row of a batch says how many, and whether the counts add up.
    """

    def take_in(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query_id = _query_id(session, checkpoint)
        key = [F.lit(query_id).alias("query_id"), F.lit(batch_id).cast("long").alias("batch_id")]
        # files are read and parsed once; executors may be lost between the jobs that follow
        parsed = written(parse_lines(batch), "stream-batch")
        held = _known_files(session, stream_raw, query_id, batch_id)
        is_held = F.lit(False)
        if held is not None:
            parsed_lines = parsed.join(held.withColumn("is_held", F.lit(True)), "source_file", "left")
            is_held = F.coalesce("is_held", F.lit(False))
        else:
            parsed_lines = parsed
        fated = parsed_lines.withColumn("is_held", is_held).withColumn("fate", _fate())
        files = parsed.select("source_file", *key).distinct()
        _store(files, _files(stream_raw, "begun"), ("query_id", "batch_id"))
        stamp = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
        rows = (
            fated.where("fate = 'written'")
            .withColumnsRenamed({"year": "partition_year", "month": "partition_month"})
            .withColumn("loaded_at", stamp)
            .select(*RAW_ORDER.fieldNames(), *key)
        )
        aside = fated.where("fate in ('corrupt', 'undated', 'stray')").select(
            F.col("path_period").alias("period"), F.col("fate").alias("reason"),
            F.coalesce("line", F.to_json(F.struct("invoice_no", "stock_code", "quantity", "invoice_date", "unit_price", "customer_id", "country"))).alias("line"),
            *key,
        )
        touched = rows.select(period_key("partition_year", "partition_month").alias("period")).distinct().collect()  # one row per period
        ledger.strike(session, stream_raw, [r["period"] for r in touched])
        _store(rows, stream_raw, STREAM_PARTITION)
        _store(aside, quarantine, ("period", "query_id", "batch_id"))
        # what was written is counted where it lies
        back = session.read.schema("invoice_no string, query_id string, batch_id long").parquet(stream_raw)
        there = back.where((F.col("query_id") == query_id) & (F.col("batch_id") == batch_id)).count()
        fates = {n: F.count_if(F.col("fate") == n) for n in ("blank", "corrupt", "undated", "stray", "repeated")}
        counts = fated.agg(F.count(F.lit(1)).alias("source_lines"), *[c.alias(f"{n}_rows") for n, c in fates.items()])
        aside_or_blank = F.expr("blank_rows + corrupt_rows + undated_rows + stray_rows + repeated_rows")
        difference = F.lit(there) + aside_or_blank - F.col("source_lines")
        status = F.when(difference != 0, "unbalanced").when(F.col("stray_rows") > 0, "stray_rows").otherwise("converted")
        record = counts.select(
            *key, F.current_timestamp().alias("recon_at"), "source_lines", "blank_rows", "corrupt_rows", "undated_rows", "stray_rows",
            "repeated_rows", F.lit(there).cast("long").alias("rows_written"), difference.cast("long").alias("difference"),
            (difference == 0).alias("balanced"), status.alias("status"),
        )
        _store(record, audit, ("query_id", "batch_id"))
        _store(files, _files(stream_raw, "done"), ("query_id", "batch_id"))
        forget(parsed)

    query = (
        stream_lines(spark, folder, max_files)
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # once for all batches; a run that stopped between the two is caught up on here
    return refresh_from_ledgers(spark, raw, stream_raw, stg)
