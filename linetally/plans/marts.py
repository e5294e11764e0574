"""Star schema: order lines, orders, monthly revenue and the dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linetally.env import written
from linetally.fixed_values import CALENDAR_END, CALENDAR_START, DEFAULT_INDICATOR_YEAR, SEGMENTS
from linetally.functions.columns import average_price, folded_units, money, money_out, ratio, total_units, unit_sums, wide
from linetally.operators.aggregates import most_frequent
from linetally.operators.ranking import ONE_TASK_ROWS, hash_buckets_for, hot_hash_buckets, ntile_by_selection, ntile_over_all

LINE_COLUMNS = (
    "invoice_no",
    "stock_code",
    "description",
    "customer_id",
    "country",
    "invoice_date",
    "period",
    "quantity",
    "unit_price",
    "line_amount",
    "is_cancellation",
    "line_type",
    "source_system",
)

# what an order is made of
ORDER_LINE_COLUMNS = (
    "invoice_no",
    "stock_code",
    "customer_id",
    "country",
    "period",
    "invoice_date",
    "quantity",
    "line_amount",
    "is_cancellation",
)


def _live(value: Column, otherwise=0) -> Column:
    """The value on lines that are not cancellations."""
    return F.when(~F.col("is_cancellation"), value).otherwise(F.lit(otherwise))


def fct_order_lines(stg: DataFrame) -> DataFrame:
    """One row per genuine line. This is the only place where copies are removed."""
    return stg.where("duplicate_occurrence = 1").select(*LINE_COLUMNS)


def fct_orders(lines: DataFrame, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """One row per invoice.

    Lines are shuffled once, by invoice, and folded where they are then. Invoices in a hash bucket with more lines than
    ``one_task_rows`` are folded before each shuffle instead, so that a huge one is split. ``lines`` should read from a
    table, since it is looked at more than once.
    """
    lines = lines.select(*ORDER_LINE_COLUMNS)
    total, limit = lines.count(), max(1, one_task_rows)
    bucket = F.pmod(F.xxhash64("invoice_no"), F.lit(hash_buckets_for(total, limit)))
    hot = hot_hash_buckets(lines, bucket, limit) if total > limit else {}
    if not hot:
        return _folded_orders(lines.repartition("invoice_no"))
    is_hot = bucket.isin(list(hot))
    return _folded_orders(lines.where(~is_hot).repartition("invoice_no")).unionByName(_folded_orders(lines.where(is_hot)))


def _folded_orders(lines: DataFrame) -> DataFrame:
    """Orders from lines in any layout; lines laid out by invoice are not shuffled.

    Header values are the same on all lines of an invoice; the smallest one is
    taken so that a rerun agrees. Lines are folded by invoice, stock code and
    header first: that is a hash aggregate over numbers, it splits a huge
    invoice, and only the folded rows are sorted for the smallest texts.
    """
    folded = lines.groupBy("invoice_no", "stock_code", "customer_id", "country", "period").agg(
        F.min("invoice_date").alias("invoice_date"),
        F.sum("quantity").alias("quantity"),
        *unit_sums(money("line_amount"), "revenue"),
        F.max(F.col("is_cancellation").cast("int")).alias("cancelled"),
    )
    return folded.groupBy("invoice_no").agg(
        F.min("customer_id").alias("customer_id"),
        F.min("country").alias("country"),
        F.min("period").alias("period"),
        F.min("invoice_date").alias("invoice_date"),
        F.count_distinct("stock_code").alias("line_item_count"),
        F.sum("quantity").alias("total_quantity"),
        money_out(folded_units("revenue")).alias("total_revenue"),
        (F.max("cancelled") > 0).alias("is_cancelled_order"),
    )


def with_avg_line_value(orders: DataFrame) -> DataFrame:
    """Orders with revenue per distinct stock code."""
    return orders.withColumn("avg_line_value", ratio(F.col("total_revenue"), F.col("line_item_count")))


def fct_revenue_monthly(orders: DataFrame) -> DataFrame:
    """One row per period and country, cancelled orders kept apart from revenue.

    Orders are unique per invoice, so orders are counted rather than distinct-
    counted. The change is against the previous period the country has; it is
    NULL in its first period and 0 after a period without revenue.
    """
    kept, cancelled = ~F.col("is_cancelled_order"), F.col("is_cancelled_order")
    revenue = wide(money("total_revenue"))
    has_number = F.col("invoice_no").isNotNull()
    monthly = orders.groupBy("period", "country").agg(
        F.count_if(kept & has_number).alias("total_orders"),
        money_out(F.sum(F.when(kept, revenue).otherwise(F.lit(0)))).alias("total_revenue"),
        F.sum(F.when(kept, F.col("total_quantity")).otherwise(F.lit(0))).alias("total_units"),
        F.count_distinct(F.when(kept, F.col("customer_id"))).alias("total_customers"),
        F.count_if(cancelled & has_number).alias("cancelled_orders"),
        money_out(F.sum(F.when(cancelled, F.abs(revenue)).otherwise(F.lit(0)))).alias("cancelled_revenue"),
    )
    by_country = Window.partitionBy("country").orderBy("period")
    prior = F.col("prior_period_revenue")
    return monthly.withColumn("prior_period_revenue", F.lag("total_revenue").over(by_country)).select(
        "*",
        F.when(prior == 0, F.lit(0.0))
        .otherwise(ratio(F.col("total_revenue") - prior, prior))
        .alias("revenue_mom_change"),
        prior.isNull().alias("is_first_period_for_country"),
    )


def customer_activity(lines: DataFrame) -> DataFrame:
    """Per customer: dates, orders, lines, units and revenue.

    Lines are folded to one row per customer and invoice first. A cancellation
    is a property of the invoice number, so both distinct counts become plain
    counts and the rows are not expanded for them.
    """
    per_invoice = lines.groupBy("customer_id", "invoice_no", "is_cancellation").agg(
        F.min("invoice_date").alias("first_date"),
        F.max("invoice_date").alias("last_date"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(_live(F.col("quantity"))).alias("units"),
        *unit_sums(_live(money("line_amount")), "revenue"),
    )
    has_number = F.col("invoice_no").isNotNull()
    return per_invoice.groupBy("customer_id").agg(
        F.min("first_date").alias("first_order_date"),
        F.max("last_date").alias("last_order_date"),
        F.count_if(has_number & ~F.col("is_cancellation")).alias("total_orders"),
        F.count_if(has_number & F.col("is_cancellation")).alias("total_cancelled_orders"),
        F.sum("n_lines").alias("total_line_items"),
        F.sum("units").alias("total_units_purchased"),
        money_out(folded_units("revenue")).alias("total_revenue"),
    )


def customer_country(lines: DataFrame) -> DataFrame:
    """The country most lines of a customer went to."""
    return most_frequent(lines.where(F.col("customer_id").isNotNull()), "customer_id", "country")


def dim_customer(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per known customer with recency, frequency, monetary value and segment.

    Recency is counted from the last invoice in the data, not from today. The
    per-customer rows are written once: the reference date, the customer count
    and the segments all come from them. Revenue ties go by customer id.
    The ends of the segments are selected; with ``partitions`` all customers
    are ranked by ranges instead.
    """
    known = lines.where(F.col("customer_id").isNotNull())
    customers = written(customer_activity(known).join(customer_country(known), "customer_id"), "customers")
    reference_date = F.lit(customers.agg(F.max("last_order_date")).first()[0]).cast("timestamp_ntz")

    if partitions is None:
        tiled = ntile_by_selection(customers, 3, "total_revenue", "customer_id", "tile")
    else:
        by_revenue = [F.col("total_revenue").asc_nulls_last(), F.col("customer_id").asc()]
        tiled = ntile_over_all(customers, 3, by_revenue, "tile", partitions)
    orders, cancelled, revenue = F.col("total_orders"), F.col("total_cancelled_orders"), F.col("total_revenue")
    segment = F.when(F.col("tile") == 3, SEGMENTS[3]).when(F.col("tile") == 2, SEGMENTS[2]).otherwise(SEGMENTS[1])
    return tiled.select(
        "customer_id",
        "country",
        "first_order_date",
        "last_order_date",
        F.datediff("last_order_date", "first_order_date").alias("customer_tenure_days"),
        "total_orders",
        "total_cancelled_orders",
        "total_line_items",
        "total_units_purchased",
        "total_revenue",
        ratio(cancelled, orders + cancelled).alias("cancellation_rate"),
        ratio(revenue, orders).alias("avg_order_value"),
        F.datediff(reference_date, F.col("last_order_date")).alias("rfm_recency_days"),
        orders.alias("rfm_frequency"),
        revenue.alias("rfm_monetary"),
        segment.alias("customer_segment"),
    )


def product_description(lines: DataFrame) -> DataFrame:
    """The description most lines of a product carry."""
    return most_frequent(lines.where(F.col("description").isNotNull()), "stock_code", "description")


def dim_product(lines: DataFrame) -> DataFrame:
    """One row per stock code; the description is NULL where no line has one."""
    products = lines.groupBy("stock_code").agg(
        F.min("invoice_date").alias("first_sold_date"),
        F.max("invoice_date").alias("last_sold_date"),
        F.count_distinct("invoice_no").alias("total_orders_containing"),
        F.sum(_live(F.col("quantity"))).alias("total_units_sold"),
        money_out(total_units(_live(money("line_amount")))).alias("total_revenue"),
        F.sum(F.when(F.col("is_cancellation"), F.abs("quantity")).otherwise(F.lit(0))).alias("total_cancelled_units"),
        average_price(_live(F.col("unit_price"), None)).alias("avg_unit_price"),
    )
    cancelled, sold = F.col("total_cancelled_units"), F.col("total_units_sold")
    return products.join(product_description(lines), "stock_code", "left").select(
        "stock_code",
        "description",
        "first_sold_date",
        "last_sold_date",
        "total_orders_containing",
        "total_units_sold",
        "total_revenue",
        "total_cancelled_units",
        "avg_unit_price",
        ratio(cancelled, sold + cancelled).alias("cancellation_rate"),
    )


def country_activity(lines: DataFrame) -> DataFrame:
    """Orders, customers and revenue per country.

    Folding to (country, invoice, customer) before the two distinct counts
    shrinks what they have to expand and spreads a dominant country.
    """
    folded = lines.groupBy("country", "invoice_no", "customer_id").agg(
        *unit_sums(_live(money("line_amount")), "revenue")
    )
    return folded.groupBy("country").agg(
        F.count_distinct("invoice_no").alias("total_orders"),
        F.count_distinct("customer_id").alias("total_customers"),
        money_out(folded_units("revenue")).alias("total_revenue"),
    )


def dim_country(
    mapping: DataFrame,
    wb_countries: DataFrame,
    wb_indicators: DataFrame,
    lines: DataFrame,
    indicator_year: str = DEFAULT_INDICATOR_YEAR,
) -> DataFrame:
    """One row per mapped country string, enriched where the mapping resolves.

    Indicators are per year, so one year is chosen; joining on the country
    alone would repeat rows as soon as a second year is loaded. The sides are
    joined without hints: AQE broadcasts the small ones from measured sizes.
    """
    wb = wb_countries.select(
        F.col("country_id").alias("worldbank_country_id"), "country_name", "region_name", "income_level_name"
    )
    indicators = wb_indicators.where(F.col("year") == indicator_year).select(
        F.col("country_id").alias("worldbank_country_id"), "gdp_usd", "population", "gdp_per_capita_usd"
    )
    activity = country_activity(lines).withColumnRenamed("country", "retail_country")
    none = F.lit(0)
    return (
        mapping.join(wb, "worldbank_country_id", "left")
        .join(indicators, "worldbank_country_id", "left")
        .join(activity, "retail_country", "left")
        .select(
            "retail_country",
            "worldbank_country_id",
            "mapping_type",
            "country_name",
            "region_name",
            "income_level_name",
            "gdp_usd",
            "population",
            "gdp_per_capita_usd",
            F.coalesce("total_orders", none).alias("total_orders"),
            F.coalesce("total_customers", none).alias("total_customers"),
            F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
            ratio(F.col("total_revenue"), F.col("population")).alias("revenue_per_capita"),
        )
    )


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` up to but not including ``end``."""
    first, last = F.to_date(F.lit(start)), F.date_sub(F.to_date(F.lit(end)), 1)
    return calendar_days(spark.range(1).select(F.explode(F.sequence(first, last)).alias("date_day")))


def calendar_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of ``date_day``. Sunday is day 0."""
    day = F.col("date_day")
    weekday = F.dayofweek(day) - 1
    return days.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
        (day == F.last_day(day)).alias("is_month_end"),
        F.date_format(day, "yyyy-MM").alias("period"),
    )
