"""Partitioned writes, partition removal and file listings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.env import shuffles_removed


def write_periods(
    df: DataFrame, path: str, by: tuple[str, ...], rebalance: bool = True, fmt: str = "parquet", compression: str = "snappy"
) -> None:
    """Replace exactly the partitions present in ``df``, leaving the others alone.

    The rebalance hint lets AQE size the files: a period with a third of all
    rows is split over many tasks, small ones share a task, and each small
    period ends up as one file. Input that is already laid out by period can
    skip that shuffle.
    """
    out = df.hint("rebalance", *by) if rebalance else df
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    with shuffles_removed(df.sparkSession):
        if fmt == "json":
            # nulls are written out, so every line has every field
            writer.option("ignoreNullFields", "false").json(path)
        else:
            writer.option("compression", compression).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def existing(spark: SparkSession, globs: Iterable[str]) -> list[str]:
    """Those of the folder patterns that match something."""
    out = []
    for glob in globs:
        fs, p = hadoop_path(spark, glob)
        if fs.globStatus(p):
            out.append(glob)
    return out


def drop_partition(spark: SparkSession, path: str) -> bool:
    """Remove one partition folder. A dynamic overwrite never empties one."""
    fs, p = hadoop_path(spark, path)
    return fs.delete(p, True)


def file_listing(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(source_file, bytes) below a path. File contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select(F.col("path").alias("source_file"), F.col("length").alias("bytes"))
    )
