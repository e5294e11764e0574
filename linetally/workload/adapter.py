"""Order-line data derived from the test tables.

The test tables are clean, so dirt (cancellations, missing customers, copies,
corrupt and undated lines, ...) is added by rules on the keys. The same rules
are written in SQL in :mod:`linetally.workload.oracles`.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.fixed_values import BATCH, GDP, POPULATION, STREAM
from linetally.functions.columns import period_key
from linetally.schemas import LANDED_ORDER
from linetally.sources.csv_orders import landed_form

FIRST_LOAD = datetime(2001, 12, 1)
SECOND_LOAD = datetime(2001, 12, 2)
INGESTED = datetime(2001, 11, 30)
STREAM_FROM = "2001-07-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per source line, with the order key that decides on copies.

    All joins are left to AQE: lineitem is shuffled by part key, then with
    orders by order key, unless the other side's measured size allows to
    broadcast it. The joined rows are laid out by month while they are keys,
    numbers and the part's name, the lines of an order next to each other, so
    that what they share is compressed; other texts are made of them after that.
    """

    def t(name):
        return table(spark, sf_dir, name)

    nation = t("nation").select(F.col("n_nationkey").alias("country_key"), F.col("n_name").alias("country"))
    orders = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    moved = F.when(F.col("l_orderkey") % 13 == 0, 1).otherwise(0)
    date = F.col("o_orderdate")
    used = ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "o_custkey", "o_orderdate", "p_name")
    lines = lines.select(*used, ((F.col("c_nationkey") + moved) % 25).alias("country_key"), (F.year(date) * 12 + F.month(date)).alias("order_month"))
    lines = lines.hint("rebalance", "order_month").join(nation, "country_key")

    order_text = F.col("l_orderkey").cast("string")
    is_cancelled = F.col("l_orderkey") % 50 == 0
    goes_back = is_cancelled | (F.col("l_orderkey") % 211 == 0)
    quantity = F.col("l_quantity").cast("int")
    return lines.select(
        F.when(is_cancelled, F.concat(F.lit("C"), order_text)).otherwise(order_text).alias("invoice_no"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.when(F.col("l_partkey") % 97 == 0, None)
        .when(F.col("l_linenumber") % 5 == 0, F.concat(F.lit(" "), F.upper("p_name")))
        .otherwise(F.col("p_name"))
        .alias("description"),
        F.when(goes_back, -quantity).otherwise(quantity).alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 331 == 0, 0.0)
        .otherwise(F.col("l_extendedprice") / F.col("l_quantity"))
        .alias("unit_price"),
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey").cast("string")).alias("customer_id"),
        "country",
        F.when(F.col("o_orderdate") >= F.lit(STREAM_FROM).cast("timestamp_ntz"), STREAM)
        .otherwise(BATCH)
        .alias("source_system"),
        F.lit(INGESTED).cast("timestamp").alias("ingested_at"),
        F.col("l_orderkey").alias("order_key"),
    )


def raw_orders(lines: DataFrame) -> DataFrame:
    """RAW rows: every line once, and some orders again from a second file and load."""
    is_copied = F.col("order_key") % 40 == 0
    loads = F.when(is_copied, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    year, month = F.year("invoice_date"), F.month("invoice_date")
    return lines.withColumn("load_no", F.explode(loads)).select(
        *[c for c in lines.columns if c != "order_key"],
        F.concat(
            F.lit("orders/year="), year, F.lit("/month="), month, F.lit("/part-"), F.col("load_no"), F.lit(".snappy.parquet")
        ).alias("source_file"),
        F.when(F.col("load_no") == 1, F.lit(FIRST_LOAD)).otherwise(F.lit(SECOND_LOAD)).cast("timestamp").alias("loaded_at"),
        year.alias("partition_year"),
        month.alias("partition_month"),
    )


def landed_text(raw_rows: DataFrame) -> DataFrame:
    """Landed text lines (event_date, value): some are cut short, some have no usable date.

    The rules look at the stock code and the quantity only, so that the SQL
    side can follow them on the same columns.
    """
    form = landed_form(raw_rows.withColumn("event_date", F.col("invoice_date").cast("date")))
    form = form.withColumn("invoice_date", F.when(is_undated(), F.lit("not a date")).otherwise(F.col("invoice_date")))
    body = F.to_json(F.struct(*LANDED_ORDER.fieldNames()), {"ignoreNullFields": "false"})
    return form.select("event_date", F.when(is_cut(), F.substring(body, 1, 20)).otherwise(body).alias("value"))


def is_cut():
    return (F.col("stock_code").cast("bigint") * 7 + F.col("quantity")) % 997 == 0


def is_undated():
    return (F.col("stock_code").cast("bigint") * 3 + F.col("quantity")) % 499 == 0


def audit_records(raw: DataFrame) -> DataFrame:
    """Audit records (job, period, run, text) with every kind of trouble in them.

    One record per period, except: none for one period, an older failed one
    for every March, a wrong row count each May, an unbalanced run each July,
    an unknown count each February of one year, and one for a period RAW lacks.
    """
    counts = raw.groupBy("partition_year", "partition_month").agg(F.count(F.lit(1)).alias("n"))
    year, month = F.col("partition_year"), F.col("partition_month")
    base = counts.where(~((year == 1996) & (month == 11))).select("partition_year", "partition_month", "n")
    newest = base.withColumn("attempt", F.lit(1))
    older = base.where(month == 3).withColumn("attempt", F.lit(0))
    unloaded = counts.agg(F.max("partition_year").alias("partition_year")).select(
        "partition_year", F.lit(12).alias("partition_month"), F.lit(5).cast("bigint").alias("n"), F.lit(1).alias("attempt")
    )
    rows = newest.unionByName(older).unionByName(unloaded)
    old = F.col("attempt") == 0
    corrupt, undated = month % 3, month % 2
    back = (
        F.when(old, 0)
        .when((year == 1997) & (month == 2), None)
        .when(month == 5, F.col("n") - 1)
        .otherwise(F.col("n"))
    )
    day = F.when(old, "2001-11-29").otherwise("2001-11-30")
    record = F.struct(
        F.concat(F.lit("run-"), period_key(year, month), F.lit("-"), F.col("attempt").cast("string")).alias("run_id"),
        F.lit("json-to-parquet").alias("job_name"),
        period_key(year, month).alias("period"),
        F.concat(day, F.lit("T06:00:00+00:00")).alias("recon_at"),
        (F.col("n") + corrupt + undated).alias("source_lines"),
        corrupt.alias("corrupt_rows"),
        undated.alias("undated_rows"),
        F.col("n").alias("expected_rows"),
        back.alias("rows_written_back"),
        (back - F.col("n")).alias("difference"),
        (~old & (month != 7)).alias("balanced"),
        F.struct(
            (F.col("n") + undated).alias("rows_total"),
            F.lit(0).alias("null_invoice_no"),
            month.alias("null_customer_id"),
            (month * 2).alias("negative_quantity"),
            (month * 3).alias("non_positive_price"),
            (month * 4).alias("cancellations"),
            undated.alias("unparseable_date"),
        ).alias("quality"),
    )
    return rows.select(record.alias("r")).select(
        F.col("r.job_name").alias("job"),
        F.col("r.period").alias("period"),
        F.col("r.run_id").alias("run"),
        F.to_json("r", {"pretty": "true", "ignoreNullFields": "false"}).alias("value"),
    )


def country_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mapping row per nation; three of them cannot be mapped."""
    nk = F.col("n_nationkey")
    kind = (
        F.when(nk % 10 == 2, "unmappable").when(nk % 3 == 0, "exact").when(nk % 3 == 1, "alias").otherwise("assumed")
    )
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("retail_country"),
        F.when(nk % 10 != 2, F.concat(F.lit("N"), F.lpad(nk.cast("string"), 2, "0"))).alias("worldbank_country_id"),
        kind.alias("mapping_type"),
        F.when(nk % 3 == 1, F.concat(F.lit("also known as "), F.lower("n_name"))).alias("note"),
    )


def reference_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved API pages (dataset, page number, text) for countries and both indicators."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    customer = table(spark, sf_dir, "customer")

    def s(value, name):
        return (F.lit(value) if isinstance(value, str) else value).cast("string").alias(name)

    def code(name, key):
        return F.concat(F.lit(name), F.lpad(key.cast("string"), 2, "0"))

    nk, rk = F.col("n_nationkey"), F.col("r_regionkey")
    levels = F.when(nk % 3 == 0, "HIC").when(nk % 3 == 1, "LMC").otherwise("LIC")
    country = nation.join(region, F.col("n_regionkey") == rk).select(
        code("N", nk).alias("id"),
        code("", nk).alias("iso2Code"),
        F.col("n_name").alias("name"),
        F.struct(s(code("R", rk), "id"), s(F.col("r_name"), "value")).alias("region"),
        F.struct(s("", "id"), s("", "value")).alias("adminregion"),
        F.struct(s(levels, "id"), s(F.concat(F.lit("Level "), levels), "value")).alias("incomeLevel"),
        F.struct(s("IBD", "id"), s("IBRD", "value")).alias("lendingType"),
        F.when(nk == 3, "").otherwise(F.concat(F.lit(" City "), nk)).alias("capitalCity"),
        F.when(nk == 4, "n/a").otherwise((nk + 0.5).cast("string")).alias("longitude"),
        F.when(nk == 5, "").otherwise((-nk - 0.25).cast("string")).alias("latitude"),
    )
    aggregate = region.select(
        code("A", rk).alias("id"),
        F.concat(F.lit("a"), rk).alias("iso2Code"),
        F.concat(F.lit("All of "), F.col("r_name")).alias("name"),
        F.struct(s("NA", "id"), s("Aggregates", "value")).alias("region"),
        F.struct(s("", "id"), s("", "value")).alias("adminregion"),
        F.struct(s("NA", "id"), s("Aggregates", "value")).alias("incomeLevel"),
        F.struct(s("", "id"), s("Aggregates", "value")).alias("lendingType"),
        F.lit("").alias("capitalCity"),
        F.lit("").alias("longitude"),
        F.lit("").alias("latitude"),
    )
    countries = country.unionByName(aggregate).select(
        F.lit("countries").alias("dataset"), F.col("id").alias("sort_id"), F.to_json(F.struct("*")).alias("record")
    )

    totals = (
        nation.join(customer, F.col("c_nationkey") == nk, "left")
        .groupBy(nk, "n_name")
        .agg(
            F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("gdp"),
            F.count("c_custkey").alias("population"),
        )
    )

    def indicator(dataset, ind_code, ind_name, value):
        rec = F.struct(
            F.struct(s(ind_code, "id"), s(ind_name, "value")).alias("indicator"),
            F.struct(s(code("", nk), "id"), s(F.col("n_name"), "value")).alias("country"),
            # one nation comes with a blank id, as aggregates do
            F.when(nk == 6, "").otherwise(code("N", nk)).alias("countryiso3code"),
            F.lit("2010").alias("date"),
            value.alias("value"),
        )
        return totals.select(
            F.lit(dataset).alias("dataset"),
            code("N", nk).alias("sort_id"),
            F.to_json(rec, {"ignoreNullFields": "false"}).alias("record"),
        )

    gdp = indicator("gdp", GDP, "GDP (current US$)", F.when(nk != 7, F.col("gdp").cast("double")))
    population = indicator("population", POPULATION, "Population, total", F.col("population"))
    records = countries.unionByName(gdp).unionByName(population)
    # two pages per dataset, by the last digit of the id
    records = records.withColumn("page", F.substring("sort_id", -1, 1).cast("int") % 2 + 1)
    pages = records.groupBy("dataset", "page").agg(F.array_join(F.sort_array(F.collect_list("record")), ",").alias("body"))
    head = F.concat(F.lit('[{"page":'), "page", F.lit(',"pages":2},['))
    return pages.select("dataset", "page", F.concat(head, "body", F.lit("]]")).alias("value"))
