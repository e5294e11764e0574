"""The engine's layers built from one set of test tables, each once per session.

Layers are tables in the shared scratch folder, as they are in production:
RAW is loaded once, staging is built from RAW, and the marts read the stored
order lines.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.env import COMPRESSION, Env, scratch_path, shuffles_removed, written
from linetally.plans import marts, pipeline, staging
from linetally.plans.convert import convert_months
from linetally.sources import reference
from linetally.sources.files import write_periods
from linetally.sources.raw_orders import PARTITION, read_raw
from linetally.workload import adapter

SALT = "dev-salt"


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.env = Env("dev", scratch_path(spark, "warehouse"), SALT)

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def table(self, name: str) -> DataFrame:
        return adapter.table(self.spark, self.sf_dir, name)

    # ------------------------------------------------------------ order lines

    @functools.cached_property
    def raw(self) -> DataFrame:
        rows = adapter.raw_orders(adapter.order_lines(self.spark, self.sf_dir))
        # order_lines are laid out by month
        write_periods(rows, self.env.raw_orders, PARTITION, rebalance=False, compression=COMPRESSION)
        return read_raw(self.spark, self.env.raw_orders)

    @functools.cached_property
    def stg(self) -> DataFrame:
        staging.build_stg_orders(self.raw, self.env.stg_orders)
        return staging.read_stg(self.spark, self.env.stg_orders)

    def _mart(self, name: str, df: DataFrame) -> DataFrame:
        pipeline.store_mart(df, self.env.mart(name))
        return self.spark.read.schema(df.schema).parquet(self.env.mart(name))

    @functools.cached_property
    def lines(self) -> DataFrame:
        return self._mart("fct_order_lines", marts.fct_order_lines(self.stg))

    @functools.cached_property
    def orders(self) -> DataFrame:
        return self._mart("fct_orders", marts.fct_orders(self.lines))

    @functools.cached_property
    def customers(self) -> DataFrame:
        return self._mart("dim_customer", marts.dim_customer(self.lines))

    @functools.cached_property
    def periods(self) -> list[str]:
        period = staging.touched_periods(self.raw, None)
        return period

    # ---------------------------------------------------------------- landing

    @functools.cached_property
    def landing(self) -> str:
        # gzip cannot be split, but the rebalanced files of a day are small at any size of the day
        text = adapter.landed_text(self.raw).hint("rebalance", "event_date")
        with shuffles_removed(self.spark):
            text.write.partitionBy("event_date").option("compression", "gzip").text(f"{self.env.landing}-text")
        return f"{self.env.landing}-text"

    @functools.cached_property
    def converted(self) -> DataFrame:
        """All periods converted; the audit and quarantine folders are filled on the way."""
        return convert_months(
            self.spark,
            self.landing,
            self.env.staged,
            self.env.audit,
            self.periods,
            run_id="full",
            quarantine=self.env.quarantine,
        )

    @functools.cached_property
    def finished(self) -> tuple[Env, pipeline.RunReport]:
        """Every period taken from the landing zone to the marts, in an environment of its own."""
        env = Env("run", self.scratch("run"), self.env.salt, landing_root=self.landing)
        self.raw_countries.write.parquet(env.raw_countries)
        self.raw_indicators.write.parquet(env.raw_indicators)
        self.mapping.write.option("header", "true").csv(env.country_mapping)
        return env, pipeline.run(self.spark, env, self.periods, adapter.FIRST_LOAD, raise_on_failure=False)

    # ------------------------------------------------------------------ audit

    @functools.cached_property
    def recon_raw(self) -> DataFrame:
        folder = self.scratch("audit")
        adapter.audit_records(self.raw).write.partitionBy("job", "period", "run").text(folder)
        staging.load_recon_raw(self.spark, folder, self.env.recon_raw, adapter.FIRST_LOAD)
        return self.spark.read.parquet(self.env.recon_raw)

    @functools.cached_property
    def recon(self) -> DataFrame:
        return written(staging.stg_glue_recon(self.recon_raw), "stg_glue_recon")

    # --------------------------------------------------------- reference data

    @functools.cached_property
    def pages(self) -> DataFrame:
        folder = self.scratch("pages")
        adapter.reference_pages(self.spark, self.sf_dir).write.partitionBy("dataset", "page").text(folder)
        return reference.read_pages(self.spark, folder)

    @functools.cached_property
    def ingested(self):
        return F.lit(adapter.INGESTED).cast("timestamp")

    @functools.cached_property
    def reference_landing(self) -> tuple[str, DataFrame]:
        folder = self.scratch("reference")
        audit = reference.land_reference(
            reference.flatten_countries(self.pages, self.ingested),
            reference.flatten_indicators(self.pages, self.ingested),
            folder,
        )
        return folder, audit

    @functools.cached_property
    def raw_countries(self) -> DataFrame:
        reference.load_countries(self.spark, self.reference_landing[0], self.env.raw_countries, adapter.FIRST_LOAD)
        return self.spark.read.parquet(self.env.raw_countries)

    @functools.cached_property
    def raw_indicators(self) -> DataFrame:
        reference.load_indicators(self.spark, self.reference_landing[0], self.env.raw_indicators, adapter.FIRST_LOAD)
        return self.spark.read.parquet(self.env.raw_indicators)

    @functools.cached_property
    def mapping(self) -> DataFrame:
        rows = adapter.country_mapping(self.spark, self.sf_dir)
        rows.write.mode("overwrite").option("header", "true").csv(self.env.country_mapping)
        return reference.read_country_mapping(self.spark, self.env.country_mapping)


_OPEN: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of this session for one set of test tables."""
    key = (spark.sparkContext.applicationId, str(sf_dir))
    if key not in _OPEN:
        _OPEN[key] = Warehouse(spark, str(sf_dir))
    return _OPEN[key]
