"""Country and indicator reference data: saved API pages to RAW tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.fixed_values import AGGREGATE_REGION, REFERENCE_API
from linetally.schemas import COUNTRY_MAPPING, LANDED_COUNTRY, LANDED_INDICATOR


class ReferenceDataError(ValueError):
    """A reference pull is incomplete, malformed, or did not land in full."""


# ---------------------------------------------------------------- saved pages


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """Saved responses, one file each, below ``dataset=<name>`` folders.

    A response is a two-element list: paging facts, then the records.
    """
    return (
        spark.read.schema("value string, dataset string")
        .text(root, wholetext=True)
        .select(
            "dataset",
            F.col("_metadata.file_path").alias("page_file"),
            F.expr("try_parse_json(value)").alias("page"),
        )
    )


def _get(variant: str, path: str, kind: str) -> Column:
    return F.try_variant_get(F.col(variant), path, kind)


def page_check(pages: DataFrame) -> DataFrame:
    """Per dataset: pages expected and seen, malformed pages, and whether it is complete."""
    well_formed = F.coalesce(
        F.expr("schema_of_variant(page) like 'ARRAY%'")
        & _get("page", "$[0].page", "int").isNotNull()
        & _get("page", "$[1]", "variant").isNotNull()
        & ~F.coalesce(F.expr("is_variant_null(try_variant_get(page, '$[1]', 'variant'))"), F.lit(True)),
        F.lit(False),
    )
    checked = pages.select(
        "dataset",
        well_formed.alias("ok"),
        F.coalesce(_get("page", "$[0].pages", "int"), F.lit(1)).alias("pages"),
        _get("page", "$[0].page", "int").alias("number"),
    )
    return (
        checked.groupBy("dataset")
        .agg(
            F.max("pages").alias("pages_expected"),
            F.count_distinct(F.when(F.col("ok"), F.col("number"))).alias("pages_seen"),
            F.count_if("ok").alias("well_formed"),
            F.count_if(~F.col("ok")).alias("malformed_pages"),
        )
        # a page that was saved twice would bring its records twice
        .withColumn(
            "complete",
            (F.col("pages_expected") == F.col("pages_seen"))
            & (F.col("well_formed") == F.col("pages_seen"))
            & (F.col("malformed_pages") == 0),
        )
        .drop("well_formed")
    )


def require_complete(pages: DataFrame) -> None:
    """Raise when any dataset misses a page, repeats one or holds a malformed one."""
    bad = page_check(pages).where(~F.col("complete")).collect()  # one row per dataset
    if bad:
        raise ReferenceDataError("incomplete pull: " + "; ".join(f"{r['dataset']} {r.asDict()}" for r in bad))


def _records(pages: DataFrame, dataset: Column) -> DataFrame:
    picked = pages.where(dataset).select("dataset", _get("page", "$[1]", "variant").alias("records"))
    return picked.lateralJoin(
        picked.sparkSession.tvf.variant_explode(F.col("records").outer())
    ).select("dataset", F.col("value").alias("rec"))


def flatten_countries(pages: DataFrame, ingested_at: Column) -> DataFrame:
    """Country records as 14 flat columns. No record is dropped, aggregates included."""

    def text(path: str) -> Column:
        return _get("rec", f"$.{path}", "string")

    return _records(pages, F.col("dataset") == "countries").select(
        text("id").alias("country_id"),
        text("iso2Code").alias("iso2_code"),
        text("name").alias("country_name"),
        text("region.id").alias("region_id"),
        text("region.value").alias("region_name"),
        text("adminregion.id").alias("admin_region_id"),
        text("incomeLevel.id").alias("income_level_id"),
        text("incomeLevel.value").alias("income_level_name"),
        text("lendingType.id").alias("lending_type_id"),
        # only these three turn empty text into NULL
        F.nullif(text("capitalCity"), F.lit("")).alias("capital_city"),
        F.nullif(text("longitude"), F.lit("")).alias("longitude"),
        F.nullif(text("latitude"), F.lit("")).alias("latitude"),
        F.lit(REFERENCE_API).alias("source_system"),
        ingested_at.alias("ingested_at"),
    )


def flatten_indicators(pages: DataFrame, ingested_at: Column) -> DataFrame:
    """Indicator records, long form. A blank country id becomes NULL; a NULL value stays."""

    def text(path: str) -> Column:
        return _get("rec", f"$.{path}", "string")

    return _records(pages, F.col("dataset") != "countries").select(
        F.nullif(text("countryiso3code"), F.lit("")).alias("country_id"),
        text("country.value").alias("country_name"),
        text("indicator.id").alias("indicator_id"),
        text("indicator.value").alias("indicator_name"),
        text("date").alias("year"),
        _get("rec", "$.value", "double").alias("value"),
        F.lit(REFERENCE_API).alias("source_system"),
        ingested_at.alias("ingested_at"),
        "dataset",
    )


# ------------------------------------------------------------ landing and RAW


def land_reference(countries: DataFrame, indicators: DataFrame, root: str) -> DataFrame:
    """Overwrite the landed files, then check that what was fetched was written.

    Reference data is current state: every pull replaces the last one. Returns
    one audit row per dataset; raises when a count differs.
    """
    spark = countries.sparkSession
    countries.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{root}/countries")
    fetched = countries.agg(
        F.lit("countries").alias("dataset"),
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(F.col("region_id") == AGGREGATE_REGION).alias("aggregates_included"),
        F.lit(None).cast("bigint").alias("null_values"),
    )
    # every indicator dataset has its own folder below indicators/
    indicators.write.mode("overwrite").partitionBy("dataset").option("ignoreNullFields", "false").json(
        f"{root}/indicators"
    )
    fetched = fetched.unionByName(
        indicators.groupBy("dataset").agg(
            F.count(F.lit(1)).alias("fetched"),
            F.lit(None).cast("bigint").alias("aggregates_included"),
            F.count_if(F.col("value").isNull()).alias("null_values"),
        )
    )
    back = spark.read.schema(LANDED_COUNTRY).json(f"{root}/countries").agg(
        F.lit("countries").alias("dataset"), F.count(F.lit(1)).alias("written")
    )
    back = back.unionByName(
        spark.read.schema("country_id string, dataset string")
        .json(f"{root}/indicators")
        .groupBy("dataset")
        .agg(F.count(F.lit(1)).alias("written"))
    )
    return fetched.join(back, "dataset", "left").select(
        "dataset",
        "fetched",
        F.coalesce("written", F.lit(0)).alias("written"),
        (F.col("fetched") == F.coalesce("written", F.lit(0))).alias("balanced"),
        "aggregates_included",
        "null_values",
        F.lit("overwrite_in_place").alias("write_mode"),
    )


def require_balanced(audit: DataFrame) -> None:
    bad = audit.where(~F.col("balanced")).collect()  # one row per dataset
    if bad:
        raise ReferenceDataError(
            "; ".join(f"{r['dataset']}: fetched {r['fetched']} != written {r['written']}" for r in bad)
        )


def _load(landed: DataFrame, table: str, loaded_at: datetime | None) -> None:
    stamp = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    landed.withColumn("source_file", F.col("_metadata.file_path")).withColumn("loaded_at", stamp).write.mode(
        "overwrite"
    ).parquet(table)


def load_countries(spark: SparkSession, root: str, table: str, loaded_at: datetime | None = None) -> None:
    """Landed countries to RAW, replacing the table. A bad line stops the load."""
    landed = spark.read.schema(LANDED_COUNTRY).option("mode", "FAILFAST").json(f"{root}/countries")
    _load(landed, table, loaded_at)


def load_indicators(spark: SparkSession, root: str, table: str, loaded_at: datetime | None = None) -> None:
    """Every landed indicator dataset into one long RAW table, replacing it."""
    landed = (
        spark.read.schema(LANDED_INDICATOR)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", "true")
        .json(f"{root}/indicators")
    )
    _load(landed, table, loaded_at)


def country_counts(raw_countries: DataFrame) -> DataFrame:
    is_aggregate = F.col("region_id") == AGGREGATE_REGION
    return raw_countries.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_aggregate).alias("aggregates"),
        F.count_if(~F.coalesce(is_aggregate, F.lit(False))).alias("actual_countries"),
    )


def indicator_nulls(raw_indicators: DataFrame) -> DataFrame:
    return (
        raw_indicators.groupBy("indicator_id", "year")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count("value").alias("non_null_values"),
            F.count_if(F.col("value").isNull()).alias("null_values"),
        )
        .orderBy("indicator_id", "year")
    )


# ----------------------------------------------------------------------- seed


def read_country_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The hand-kept mapping CSV; every column is text and empty means NULL."""
    return spark.read.schema(COUNTRY_MAPPING).option("header", "true").option("enforceSchema", "false").csv(path)


def write_default_mapping(spark: SparkSession, path: str) -> None:
    """Write the shipped mapping as the CSV that :func:`read_country_mapping` reads."""
    from linetally.fixed_values import COUNTRY_MAPPING as rows

    spark.createDataFrame(rows, COUNTRY_MAPPING).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
