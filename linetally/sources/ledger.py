"""What a table holds, period by period, kept beside it: rows, newest load and a fingerprint of the content.

A fingerprint is a set of sums over row hashes, so it depends on neither row order nor files, counts copies, and adds up:
that of two stores together is the sum of theirs. 24 bits of a hash are summed at a time, so half a trillion rows of a
period fit in a BIGINT; four sums from two hashes make 96 bits.

Entries of the periods a write touches are struck out before it and entered after it. A write that stops in between
leaves its periods without an entry; these are measured again, alone, by :func:`brought_up`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.env import shuffles_removed
from linetally.functions.columns import ORDER_COLUMNS, period_key
from linetally.sources import versions
from linetally.sources.files import drop_partition, path_exists

#: Sums of the line as landed, and of its cleaned form, which staging keeps.
RAW_SUMS = tuple(f"raw_sum_{i}" for i in range(4))
CLEAN_SUMS = tuple(f"clean_sum_{i}" for i in range(4))
ENTRY = "n bigint, newest timestamp, " + ", ".join(f"{c} bigint" for c in RAW_SUMS + CLEAN_SUMS)

_PIECE = (1 << 24) - 1


def content_sums(columns: Iterable[str | Column], names: tuple[str, ...], where: Column | None = None) -> list[Column]:
    """The four sums over rows of these columns; NULL is a value of its own."""
    columns = [F.col(c) if isinstance(c, str) else c for c in columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    hashes = F.xxhash64(nulls, *columns), F.xxhash64(F.lit("second"), nulls, *columns)
    pieces = [F.shiftright(h, bits).bitwiseAND(F.lit(_PIECE)) for h in hashes for bits in (0, 24)]
    return [F.coalesce(F.sum(p if where is None else F.when(where, p)), F.lit(0)).alias(n) for p, n in zip(pieces, names, strict=True)]


def line_sums(where: Column | None = None) -> list[Column]:
    """Fingerprint of lines as they were landed."""
    return content_sums(ORDER_COLUMNS, RAW_SUMS, where)


def clean_sums() -> list[Column]:
    """Fingerprint of lines as staging keeps them; the same over RAW and over staging."""
    trimmed = [F.trim(c) if c in ("description", "country") else F.col(c) for c in ORDER_COLUMNS]
    return content_sums([*trimmed, "source_file"], CLEAN_SUMS)


def measured(rows: DataFrame) -> DataFrame:
    """Entries of the periods of RAW or staging rows."""
    staged = "period" in rows.columns
    period = F.col("period") if staged else period_key("partition_year", "partition_month")
    lines = [F.lit(None).cast("bigint").alias(c) for c in RAW_SUMS] if staged else line_sums()
    return rows.groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("n"), F.max("loaded_at").alias("newest"), *lines, *clean_sums())


def measured_lines(rows: DataFrame, period: Column) -> DataFrame:
    """Entries of the periods of landed or staged lines, which have no load yet."""
    none = [F.lit(None).cast("timestamp").alias("newest"), *[F.lit(None).cast("bigint").alias(c) for c in CLEAN_SUMS]]
    counted = rows.groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("n"), *line_sums())
    return counted.select("period", "n", *RAW_SUMS, *none)


def _folder(table: str) -> str:
    return f"{table}/_ledger"  # readers of the table pass over it


def entries(spark: SparkSession, table: str) -> DataFrame:
    """All entries of a table; none if it has no ledger."""
    schema = f"{ENTRY}, period string"
    return spark.read.schema(schema).parquet(_folder(table)) if path_exists(spark, _folder(table)) else spark.createDataFrame([], schema)


def strike(spark: SparkSession, table: str, periods: Iterable[str] | None = None) -> None:
    """Take out the entries of these periods, or all."""
    if periods is None:
        drop_partition(spark, _folder(table))
    for period in periods or ():
        drop_partition(spark, f"{_folder(table)}/period={period}")


def enter(entries_of: DataFrame, table: str) -> None:
    """Store measured entries; each period has one."""
    out = entries_of.select("n", "newest", *RAW_SUMS, *CLEAN_SUMS, "period").hint("coalesce", 1)
    with shuffles_removed(entries_of.sparkSession):
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(_folder(table))


def periods_of(spark: SparkSession, table: str) -> set[str]:
    """Periods a table has folders for; names are listed, no file is looked at."""
    found = set()
    for by in (("partition_year", "partition_month"), ("period",)):
        for partition in versions.partitions(spark, table, by):
            values = [p.split("=", 1)[1] for p in partition.split("/")]
            if len(values) == len(by) and all(v.replace("-", "").isdigit() for v in values):
                found.add(values[0] if len(values) == 1 else f"{int(values[0]):04d}-{int(values[1]):02d}")
    return found


def brought_up(spark: SparkSession, table: str, read: Callable[[list[str]], DataFrame]) -> DataFrame:
    """The entries of all periods of a table. Those without one are measured, reading their partitions only."""
    there = periods_of(spark, table)
    known = {r["period"] for r in entries(spark, table).select("period").collect()}  # one row per period
    strike(spark, table, known - there)
    missing = sorted(there - known)
    if missing:
        enter(measured(read(missing)), table)
    return entries(spark, table)


def added_up(*ledgers: DataFrame) -> DataFrame:
    """Entries of several stores of one table taken together."""
    both = ledgers[0]
    for more in ledgers[1:]:
        both = both.unionByName(more)
    return both.groupBy("period").agg(F.sum("n").alias("n"), F.max("newest").alias("newest"), *[F.sum(c).alias(c) for c in RAW_SUMS + CLEAN_SUMS])


def same_content(sums: tuple[str, ...], left: str, right: str) -> Column:
    """Whether two joined entries have the same fingerprint; an absent one is none."""
    out = F.lit(True)
    for c in sums:
        out = out & (F.coalesce(F.col(f"{left}.{c}"), F.lit(0)) == F.coalesce(F.col(f"{right}.{c}"), F.lit(0)))
    return out
