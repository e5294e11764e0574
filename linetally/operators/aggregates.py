"""Grouped operators built on partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def most_frequent(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key with its most frequent value.

    Ties go to the smallest value, NULL last; a NULL value competes like any
    other, which the built-in ``mode`` does not do. Counting and picking are
    both aggregates that combine before the shuffle, so a key with very many
    rows or values never has to sit in one window partition.
    """
    counted = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("rank"), F.col(value).isNull().alias("last"), F.col(value)))
    return counted.groupBy(key).agg(best.alias("__best")).select(key, F.col(f"__best.{value}").alias(value))


def latest_by(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The whole row with the greatest ``order`` columns per key, as an aggregate."""
    rest = [c for c in df.columns if c != key and c not in order]
    best = F.max(F.struct(*order, *rest))
    return df.groupBy(key).agg(best.alias("__best")).select(*[key if c == key else f"__best.{c}" for c in df.columns])


def pivot_max(names: str, value: str, wanted: dict[str, str]) -> list[Column]:
    """Conditional maxima that turn long (name, value) rows into columns."""
    return [F.max(F.when(F.col(names) == F.lit(code), F.col(value))).alias(out) for code, out in wanted.items()]


def exact_copies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows over ``columns`` with the number of copies of each."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
