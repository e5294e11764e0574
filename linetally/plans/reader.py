"""What a dashboard reader may see: rollups and dimensions, ids masked."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetally.env import Env
from linetally.functions.columns import masked

# No line-level table is on this list.
READER_TABLES = ("fct_orders", "fct_revenue_monthly", "dim_customer", "dim_product", "dim_country", "dim_date")


def mask_customers(df: DataFrame, salt: str, privileged: bool = False) -> DataFrame:
    """``customer_id`` hashed for everyone but the builder role."""
    if privileged or "customer_id" not in df.columns:
        return df
    return df.withColumn("customer_id", masked("customer_id", salt))


def reader_views(marts: Mapping[str, DataFrame], env: Env, register: bool = True) -> dict[str, DataFrame]:
    """The allowed marts with masked ids, registered as ``reader_<mart>`` views.

    Without a salt ids could be looked up by hashing all numbers, so it is asked for.
    """
    if not env.salt:
        raise ValueError("reader views need a masking salt")
    views = {name: mask_customers(marts[name], env.salt) for name in READER_TABLES if name in marts}
    if register:
        for name, view in views.items():
            view.createOrReplaceTempView(f"reader_{name}")
    return views


def suppress_small_countries(df: DataFrame, at_least: int) -> DataFrame:
    """Blank the customer id where a country has fewer than ``at_least`` customers.

    In a country with one customer a hashed id still names that customer.
    """
    sizes = df.groupBy("country").agg(F.count_distinct("customer_id").alias("__customers"))
    shown = F.when(F.col("__customers") >= at_least, F.col("customer_id"))
    joined = df.alias("d").join(sizes.alias("s"), F.col("d.country").eqNullSafe(F.col("s.country")), "left")
    return joined.select(*[shown.alias(c) if c == "customer_id" else F.col(f"d.{c}").alias(c) for c in df.columns])
