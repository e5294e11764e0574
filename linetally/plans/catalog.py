"""Every table of an environment under its own name, for SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linetally.env import Env
from linetally.plans import pipeline as P
from linetally.plans import staging as S
from linetally.sources import versions
from linetally.sources.raw_orders import read_raw
from linetally.sources.reference import read_country_mapping


def tables(spark: SparkSession, env: Env) -> dict[str, DataFrame]:
    """Stored tables, and the models kept as views over them. What is not built yet is left out."""
    out: dict[str, DataFrame] = {}

    def add(name: str, path: str, read) -> None:
        if versions.exists(spark, path):
            out[name] = read(path)

    add("raw_orders", env.raw_orders, lambda p: read_raw(spark, p))
    add("raw_worldbank_countries", env.raw_countries, spark.read.parquet)
    add("raw_worldbank_indicators", env.raw_indicators, spark.read.parquet)
    add("glue_recon_raw", env.recon_raw, spark.read.parquet)
    add("country_mapping", env.country_mapping, lambda p: read_country_mapping(spark, p))
    add("stg_orders", env.stg_orders, lambda p: S.read_stg(spark, p))
    for name in P.MARTS:
        add(name, env.mart(name), spark.read.parquet)

    # models kept as views: they always show the tables of now
    if "raw_worldbank_countries" in out:
        out["stg_worldbank_countries"] = S.stg_worldbank_countries(out["raw_worldbank_countries"])
    if "raw_worldbank_indicators" in out:
        out["stg_worldbank_indicators"] = S.stg_worldbank_indicators(out["raw_worldbank_indicators"])
    if "glue_recon_raw" in out:
        out["stg_glue_recon"] = S.stg_glue_recon(out["glue_recon_raw"])
    if {"glue_recon_raw", "raw_orders", "stg_orders"} <= out.keys():
        out["fct_pipeline_reconciliation"] = P.reconciliation(spark, env)
    return out


def register(spark: SparkSession, env: Env, prefix: str = "") -> list[str]:
    """Register all of them as temporary views; returns the names."""
    found = tables(spark, env)
    for name, df in found.items():
        df.createOrReplaceTempView(prefix + name)
    return sorted(prefix + name for name in found)
