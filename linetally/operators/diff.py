"""Comparing the tables of two environments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.env import written
from linetally.sources.ledger import content_sums, same_content


def row_counts(envs: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """(env, obj, row_count) for every table of every environment.

    A table can exist in both and be empty in one, which a column comparison
    does not show.
    """
    counts = [
        df.agg(F.lit(env).alias("env"), F.lit(obj).alias("obj"), F.count(F.lit(1)).alias("row_count"))
        for env, tables in envs.items()
        for obj, df in tables.items()
    ]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out.orderBy("obj", "env")


def column_listing(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    rows = [(obj, f.name, f.dataType.simpleString()) for obj, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, "obj string, column_name string, data_type string")


def schema_diff(
    spark: SparkSession, left_name: str, left: Mapping[str, DataFrame], right_name: str, right: Mapping[str, DataFrame]
) -> DataFrame:
    """Columns (with type) that only one of two environments has."""
    a, b = column_listing(spark, left), column_listing(spark, right)
    return a.exceptAll(b).withColumn("only_in", F.lit(left_name)).unionByName(
        b.exceptAll(a).withColumn("only_in", F.lit(right_name))
    )


def with_filled_rows(diff: DataFrame, envs: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """The diff with the number of rows that hold a value in each such column.

    One scan per table counts all of its columns.
    """
    filled = None
    for env, tables in envs.items():
        for obj, df in tables.items():
            counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
            rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled_rows")) for c in df.columns])
            part = counts.select(F.inline(rows)).withColumns({"only_in": F.lit(env), "obj": F.lit(obj)})
            filled = part if filled is None else filled.unionByName(part)
    return diff.join(filled, ["only_in", "obj", "column_name"], "left")


# Rows of one branch of a content comparison, on the mean.
ROWS_PER_BRANCH = 100_000
_SUMS = tuple(f"__sum_{i}" for i in range(4))


def _differing(left: DataFrame, right: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Groups whose rows differ between two frames, with the rows of the bigger side; both sides combine before a shuffle."""
    a, b = (
        df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), *content_sums(columns, _SUMS)).alias(side)
        for df, side in ((left, "a"), (right, "b"))
    )
    on, same = F.lit(True), F.col("a.__n").eqNullSafe(F.col("b.__n")) & same_content(_SUMS, "a", "b")
    for c in by:
        on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    # a group on one side only has no count on the other
    either = [F.when(F.col("a.__n").isNull(), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in by]
    return a.join(b, on, "full").where(~same).select(*either, F.greatest("a.__n", "b.__n").alias("__n"))


def content_diff(
    left: DataFrame,
    right: DataFrame,
    period: Column,
    columns: Sequence[str],
    names: tuple[str, str] = ("left", "right"),
    rows_per_branch: int = ROWS_PER_BRANCH,
) -> DataFrame:
    """Rows of a table that only one of two environments holds: (period, columns, only_in, copies).

    A tree of fingerprints is gone down: periods, then hash buckets of the rows
    of differing periods, then the rows of differing buckets. So equal tables
    cost one aggregate over each, and rows are shuffled only in the branches
    that differ. Order and files do not matter; copies are counted, and NULL
    is a value. ``period`` should be made of partition columns: the later steps
    then read the folders of differing periods only. Columns have to be of
    types that can be grouped.
    """
    keep = [F.col(c) for c in columns]
    a, b = (df.select(period.alias("__period"), *keep) for df in (left, right))
    found = _differing(a, b, ["__period"], columns).collect()  # one row per differing period
    differing = [r["__period"] for r in found]
    inside = F.col("__period").isin([p for p in differing if p is not None])
    if None in differing:
        inside = F.coalesce(inside, F.lit(True))
    buckets = max([1, *(-(-r["__n"] // rows_per_branch) for r in found)])
    # salted: the fingerprint's own hashes are not used twice
    bucket = F.pmod(F.xxhash64(F.lit("branch"), *keep), F.lit(buckets)).alias("__bucket")
    a, b = (df.where(inside).select("*", bucket) for df in (a, b))
    branches = _differing(a, b, ["__period", "__bucket"], columns).select("__period", "__bucket")
    branches = written(branches, "branches")  # both sides read it
    sides = []
    for df, sign in ((a, 1), (b, -1)):
        d, s = df.alias("d"), branches.alias("s")
        same = F.col("d.__period").eqNullSafe(F.col("s.__period")) & (F.col("d.__bucket") == F.col("s.__bucket"))
        sides.append(d.join(s, same, "left_semi").withColumn("__copies", F.lit(sign).cast("bigint")))
    net = sides[0].unionByName(sides[1]).groupBy("__period", *columns).agg(F.sum("__copies").alias("__copies"))
    only_in = F.when(F.col("__copies") > 0, names[0]).otherwise(names[1])
    return net.where(F.col("__copies") != 0).select(
        F.col("__period").alias("period"), *[c for c in columns if c != "period"], only_in.alias("only_in"), F.abs("__copies").alias("copies")
    )
