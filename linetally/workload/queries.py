"""One query per operator, run over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.fixed_values import BATCH, LINE_TYPES, REVENUE_TOLERANCE, STREAM
from linetally.functions.columns import money, money_out, path_number, period_key, total_units
from linetally.operators import checks as C
from linetally.operators import diff as D
from linetally.operators.ranking import ROWS_PER_TASK
from linetally.plans import catalog
from linetally.plans import convert as V
from linetally.plans import marts as M
from linetally.plans import pipeline as P
from linetally.plans import reader as R
from linetally.plans import recon as N
from linetally.plans import staging as S
from linetally.sources import csv_orders as CSV
from linetally.sources import landing as L
from linetally.sources import ledger as K
from linetally.sources import raw_orders as RAW
from linetally.sources import reference as REF
from linetally.sources.files import write_periods
from linetally.streaming.replay import read_stream_audit, replay
from linetally.workload import adapter as A
from linetally.workload.warehouse import Warehouse, warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HOLD_BACK_DAYS = 30
DUPLICATE_LIMIT = 0.03
FRESH_AS_OF = "2001-12-15 00:00:00"
SMALL_COUNTRY = 50
ORDER_FIELDS = CSV.LANDED_ORDER.fieldNames()


def query(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(warehouse(spark, sf_dir))
    return fn


def amount(column: str = "line_amount"):
    return money_out(total_units(money(column)))


def by_period(stg: DataFrame, *more: str) -> DataFrame:
    """Rows, copies, units and revenue per period: enough to see any misplaced row."""
    return stg.groupBy("period", *more).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("duplicate_occurrence") > 1).alias("duplicate_rows"),
        F.sum("quantity").alias("units"),
        amount().alias("revenue"),
    )


# ------------------------------------------------------------- sources, sinks


def _write_csv(lines: DataFrame, path: str, **options: str) -> None:
    """A source CSV as gzipped files. Such a file cannot be split, so it gets no more lines than a task sorts in memory."""
    files = lines.write.options(header="true", encoding="ISO-8859-1", ignoreLeadingWhiteSpace="false", **options)
    files.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_TASK).csv(path)


def _csv(w: Warehouse) -> DataFrame:
    """RAW lines as a source CSV: old headers, ids as floats, some dates unreadable."""
    path = w.scratch("csv")
    dated = F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss")
    source = w.raw.select(
        F.col("invoice_no").alias("InvoiceNo"),
        F.col("stock_code").alias("StockCode"),
        F.col("description").alias("Description"),
        F.col("quantity").alias("Quantity"),
        F.when(A.is_undated(), F.lit("not a date")).otherwise(dated).alias("InvoiceDate"),
        F.col("unit_price").alias("UnitPrice"),
        F.concat("customer_id", F.lit(".0")).alias("CustomerID"),
        F.col("country").alias("Country"),
    )
    _write_csv(source, path)
    return CSV.prepare(CSV.scan_csv(w.spark, path))


@query
def csv_source_scan(w):
    return CSV.split_undated(_csv(w))[0]


@query
def csv_source_scan_uci(w):
    """The same lines as a file with month-first dates, quoted line breaks and doubled quotes."""
    path = w.scratch("source_csv_uci")
    source = w.raw.select(
        F.col("invoice_no").alias("InvoiceNo"),
        F.col("stock_code").alias("StockCode"),
        F.concat("description", F.lit('\nsaid "new"')).alias("Description"),
        F.col("quantity").alias("Quantity"),
        F.when(A.is_undated(), F.lit("17850")).otherwise(F.date_format("invoice_date", "M/d/yyyy H:mm:ss")).alias("InvoiceDate"),
        F.col("unit_price").alias("UnitPrice"),
        F.concat("customer_id", F.lit(".0")).alias("CustomerID"),
        F.col("country").alias("Country"),
    )
    _write_csv(source, path, escape='"')
    return CSV.split_undated(CSV.prepare(CSV.scan_csv(w.spark, path)))[0]


@query
def source_profile(w):
    return CSV.profile(CSV.split_undated(_csv(w))[0])


@query
def ndjson_month_scan(w):
    parsed = L.parse_lines(L.read_lines(w.spark, w.landing, w.periods))
    return L.good(parsed).select("path_period", *ORDER_FIELDS)


@query
def ndjson_daily_roundtrip(w):
    root = w.scratch("daily")
    CSV.write_daily(w.raw.withColumn("event_date", F.col("invoice_date").cast("date")), root)
    lines = w.spark.read.schema("value string, event_date string").text(root)
    return L.good(L.parse_lines(lines)).select("event_date", *ORDER_FIELDS)


@query
def quality_metrics(w):
    return V.quality_metrics(L.parse_lines(L.read_lines(w.spark, w.landing)))


@query
def corrupt_sample(w):
    return L.corrupt_sample(L.parse_lines(L.read_lines(w.spark, w.landing)))


@query
def stray_row_guard(w):
    """Stray lines per folder month, when every order on a 1st is filed a month late."""
    text = A.landed_text(w.raw)
    day = F.col("event_date")
    filed = F.when(F.dayofmonth(day) == 1, F.add_months(day, 1)).otherwise(day)
    lines = text.select(F.date_format(filed, "yyyy-MM").alias("path_period"), "value")
    strays = L.stray(L.parse_lines(lines))
    return strays.groupBy("path_period").agg(
        F.count(F.lit(1)).alias("stray_rows"),
        F.min("invoice_date").alias("first_stray_date"),
        F.max("invoice_date").alias("last_stray_date"),
    )


def _staged_summary(w: Warehouse, staged: str) -> DataFrame:
    rows = w.spark.read.parquet(staged)
    return rows.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("quantity").alias("units"),
        F.min("invoice_date").alias("first_invoice_date"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_id"),
    )


@query
def convert_month(w):
    staged = w.scratch("staged")
    V.convert_months(w.spark, w.landing, staged, f"{staged}-audit", w.periods)
    return _staged_summary(w, staged)


RECON_COUNTS = (
    "period",
    "source_lines",
    "corrupt_rows",
    "undated_rows",
    "expected_rows",
    "rows_written_back",
    "difference",
)


@query
def convert_month_recon(w):
    return w.converted.select(*RECON_COUNTS, "balanced", "stray_rows", "status")


@query
def backfill_months(w):
    """A range that starts and ends a month outside the data; those months fail alone."""

    def shifted(period, by):
        n = int(period[:4]) * 12 + int(period[5:]) - 1 + by
        return f"{n // 12:04d}-{n % 12 + 1:02d}"

    staged = w.scratch("staged")
    first, last = shifted(w.periods[0], -1), shifted(w.periods[-1], 1)
    try:
        recon = V.backfill(w.spark, w.landing, staged, f"{staged}-audit", first, last)
    except V.ConversionError as stopped:
        recon = stopped.recon
    return recon.select("period", "source_lines", "rows_written_back", "status")


@query
def recon_audit_record(w):
    w.converted  # noqa: B018 - fills the audit folder
    stored = S.read_audit_files(w.spark, w.env.audit).withColumn("loaded_at", F.current_timestamp())
    fields = S.recon_fields(stored)
    return fields.select(*RECON_COUNTS, "glue_balanced", *[c for c in fields.columns if c.startswith("q_")])


@query
def undated_quarantine(w):
    w.converted  # noqa: B018 - fills the quarantine folder
    aside = w.spark.read.schema("reason string, line string, period string").json(w.env.quarantine)
    return aside.groupBy("period", "reason").agg(F.count("line").alias("line_count"))


@query
def quarantine_after_rerun(w):
    """All periods are converted, the bad lines of even months are mended, and all are converted again."""
    staged, audit, aside, mended = (w.scratch(x) for x in ("staged", "audit", "aside", "mended"))
    V.convert_months(w.spark, w.landing, staged, audit, w.periods, quarantine=aside)
    parsed = L.parse_lines(L.read_lines(w.spark, w.landing).withColumn("copy", F.col("value")))
    fine = parsed.where(F.col("line").isNull() | (F.substring("path_period", 6, 2).cast("int") % 2 == 1))
    fine.select(F.col("copy").alias("value"), "event_date").write.partitionBy("event_date").option("compression", "gzip").text(mended)
    V.convert_months(w.spark, mended, staged, audit, w.periods, quarantine=aside)
    left = w.spark.read.schema("reason string, line string, period string").json(aside)
    return left.groupBy("period", "reason").agg(F.count("line").alias("line_count"))


@query
def convert_effort(w):
    """Bytes and seconds in the record of every conversion: present and above zero."""
    return w.converted.select("period", (F.col("output_bytes") > 0).alias("has_bytes"), (F.col("job_run_seconds") > 0).alias("has_seconds"))


def _stage(rows: DataFrame, staged: str) -> None:
    """RAW rows back to staged files."""
    body = [c for c in ORDER_FIELDS]
    rows = rows.withColumnsRenamed({"partition_year": "year", "partition_month": "month"})
    write_periods(rows.select(*body, "year", "month"), staged, ("year", "month"))


@query
def raw_orders_load(w):
    staged, raw = w.scratch("staged"), w.scratch("raw")
    _stage(w.raw, staged)
    RAW.load_periods(w.spark, staged, raw, w.periods, A.FIRST_LOAD)
    loaded = RAW.read_raw(w.spark, raw)
    in_path = path_number("source_file", "year") == F.col("partition_year")
    return loaded.select(
        *ORDER_FIELDS, "partition_year", "partition_month", "loaded_at", in_path.alias("source_file_matches")
    )


@query
def raw_load_skip_loaded(w):
    """Two loads of one file set, then new files: each file is taken exactly once."""
    staged, raw = w.scratch("staged"), w.scratch("raw")
    first = w.raw.where(F.col("loaded_at") == F.lit(A.FIRST_LOAD))
    _stage(first, staged)
    RAW.load_new_files(w.spark, staged, raw, A.FIRST_LOAD)
    again = RAW.load_new_files(w.spark, staged, raw, A.SECOND_LOAD)
    second = w.raw.where(F.col("loaded_at") == F.lit(A.SECOND_LOAD))
    second = second.withColumnsRenamed({"partition_year": "year", "partition_month": "month"})
    second.select(*ORDER_FIELDS, "year", "month").write.mode("append").partitionBy("year", "month").parquet(staged)
    RAW.load_new_files(w.spark, staged, raw, A.SECOND_LOAD)
    return (
        RAW.read_raw(w.spark, raw)
        .groupBy("partition_year", "partition_month", "loaded_at")
        .agg(F.count(F.lit(1)).alias("row_count"), F.lit(again).alias("files_loaded_again"))
    )


@query
def raw_orders_reload_interrupted(w):
    """A reload of every June that stops before its switch, and one that ends while a reader is open.

    The stopped reload has written its rows; readers still see the periods as they were, and so does a reader opened
    before the reload that ends.
    """
    staged, raw = w.scratch("staged"), w.scratch("raw")
    _stage(w.raw, staged)
    RAW.load_periods(w.spark, staged, raw, w.periods, A.FIRST_LOAD)
    june = [p for p in w.periods if p.endswith("-06")]
    _stage(w.raw.where(RAW.in_periods(june) & (F.col("unit_price") > 0)), staged)
    stopped = RAW.prepare_periods(w.spark, staged, raw, june, A.SECOND_LOAD)
    if not stopped.folders:
        raise AssertionError("the stopped reload wrote nothing")
    seen = {"stopped": RAW.read_raw(w.spark, raw), "open reader": RAW.read_raw(w.spark, raw)}
    RAW.load_periods(w.spark, staged, raw, june, A.SECOND_LOAD)
    seen["reloaded"] = RAW.read_raw(w.spark, raw)
    counted = [
        rows.groupBy("partition_year", "partition_month", "loaded_at").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("units"), F.lit(state).alias("state")
        )
        for state, rows in seen.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query
def raw_orders_reload(w):
    """Every June is restaged without its free lines and loaded again."""
    staged, raw = w.scratch("staged"), w.scratch("raw")
    _stage(w.raw, staged)
    RAW.load_periods(w.spark, staged, raw, w.periods, A.FIRST_LOAD)
    june = [p for p in w.periods if p.endswith("-06")]
    _stage(w.raw.where(RAW.in_periods(june) & (F.col("unit_price") > 0)), staged)
    RAW.load_periods(w.spark, staged, raw, june, A.SECOND_LOAD)
    return RAW.read_raw(w.spark, raw).groupBy("partition_year", "partition_month", "loaded_at").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("units")
    )


@query
def raw_partition_summary(w):
    return RAW.partition_summary(w.raw)


@query
def raw_null_partition_keys(w):
    """Month parsed from paths of which the February ones are misnamed."""
    path = F.regexp_replace("source_file", "/month=2/", "/m=2/")
    parsed = w.raw.withColumn("path", path).withColumn("partition_month", path_number("path", "month"))
    return RAW.null_partition_keys(parsed)


# -------------------------------------------------------------- reference data


@query
def wb_flatten_countries(w):
    return REF.flatten_countries(w.pages, w.ingested).drop("ingested_at")


@query
def wb_flatten_indicators(w):
    return REF.flatten_indicators(w.pages, w.ingested).drop("ingested_at")


@query
def wb_page_check(w):
    """The saved pages, plus an error answer in place of a third GDP page."""
    error = w.pages.where("dataset = 'gdp'").limit(1).select(
        "dataset", "page_file", F.expr("""parse_json('[{"message":"bad request","pages":3}]')""").alias("page")
    )
    return REF.page_check(w.pages.unionByName(error))


@query
def wb_fetch_recon(w):
    return w.reference_landing[1]


@query
def worldbank_countries_load(w):
    return w.raw_countries.drop("ingested_at", "source_file")


@query
def worldbank_indicators_load(w):
    return w.raw_indicators.drop("ingested_at", "source_file")


@query
def worldbank_country_counts(w):
    return REF.country_counts(w.raw_countries)


@query
def worldbank_indicator_nulls(w):
    return REF.indicator_nulls(w.raw_indicators)


@query
def seed_country_mapping(w):
    return w.mapping


@query
def stg_worldbank_countries(w):
    return S.stg_worldbank_countries(w.raw_countries).drop("ingested_at")


@query
def stg_worldbank_indicators(w):
    return S.stg_worldbank_indicators(w.raw_indicators).drop("ingested_at")


# --------------------------------------------------------------------- staging


@query
def stg_orders_full(w):
    return S.stg_orders(w.raw)


@query
def line_type_breakdown(w):
    return w.stg.groupBy("line_type").agg(F.count(F.lit(1)).alias("row_count"), amount().alias("revenue"))


@query
def duplicate_lines(w):
    return w.stg.where("duplicate_occurrence > 1").select(*S.DUPLICATE_KEY, "period", "loaded_at", "duplicate_occurrence")


@query
def duplicate_rate(w):
    return C.duplicate_rates(w.stg)


@query
def stg_orders_incremental(w):
    """Staging built from the first load, then refreshed by high-water mark."""
    table = w.scratch("stg")
    S.refresh_stg_orders(w.spark, w.raw.where(F.col("loaded_at") == F.lit(A.FIRST_LOAD)), table)
    S.refresh_stg_orders(w.spark, w.raw, table)
    return by_period(S.read_stg(w.spark, table))


@query
def stg_orders_incremental_after_reprocess(w):
    """The second load is in RAW; one period is reprocessed by name before the incremental run."""
    table = w.scratch("stg")
    S.refresh_stg_orders(w.spark, w.raw.where(F.col("loaded_at") == F.lit(A.FIRST_LOAD)), table)
    S.refresh_stg_orders(w.spark, w.raw, table, ["1996-06"])
    S.refresh_stg_orders(w.spark, w.raw, table)
    return by_period(S.read_stg(w.spark, table))


@query
def stg_orders_incremental_ledger(w):
    """The second load is appended to a stored RAW; the ledgers of RAW and staging say which periods to rebuild."""
    raw, stream, table = (w.scratch(x) for x in ("raw", "stream_raw", "stg"))
    first = F.col("loaded_at") == F.lit(A.FIRST_LOAD)
    write_periods(w.raw.where(first), raw, RAW.PARTITION)
    S.refresh_from_ledgers(w.spark, raw, stream, table)
    second = w.raw.where(~first)
    K.strike(w.spark, raw, S.touched_periods(second, None))
    second.write.mode("append").partitionBy(*RAW.PARTITION).parquet(raw)
    S.refresh_from_ledgers(w.spark, raw, stream, table)
    return by_period(S.read_stg(w.spark, table))


@query
def stg_orders_reprocess(w):
    """After a full build RAW loses the June copies and all of 1996-02; both are reprocessed."""
    table = w.scratch("stg")
    S.build_stg_orders(w.raw, table)
    month = F.col("partition_month")
    june_copy = (month == 6) & (F.col("loaded_at") == F.lit(A.SECOND_LOAD))
    changed = w.raw.where(~june_copy & ~((F.col("partition_year") == 1996) & (month == 2)))
    june = [p for p in w.periods if p.endswith("-06")]
    S.refresh_stg_orders(w.spark, changed, table, [*june, "1996-02"])
    return by_period(S.read_stg(w.spark, table))


@query
def stg_schema_guard(w):
    """Columns by which a drifted staging frame differs, with the rows that hold a value there."""
    drifted = w.stg.withColumnRenamed("country", "ship_country").withColumn("quantity", F.col("quantity").cast("bigint"))
    try:
        S.require_same_columns(w.stg.schema, drifted.schema)
        raise AssertionError("drift was not noticed")
    except S.SchemaDriftError:
        pass
    envs = {"table": {"stg_orders": w.stg}, "drifted": {"stg_orders": drifted}}
    found = D.schema_diff(w.spark, "table", envs["table"], "drifted", envs["drifted"])
    return D.with_filled_rows(found, envs)


@query
def stg_recon_latest(w):
    return S.stg_glue_recon(w.recon_raw).drop("source_file")


@query
def recon_raw_load(w):
    return S.recon_fields(w.recon_raw).drop("source_file")


# ------------------------------------------------------------------------ recon


def _stale_staging(w: Warehouse) -> DataFrame:
    """Staging as it would be had the second load of each September not been staged."""
    stale = (F.substring("period", 6, 2) == "09") & (F.col("loaded_at") == F.lit(A.SECOND_LOAD))
    return w.stg.where(~stale)


@query
def pipeline_reconciliation(w):
    return N.pipeline_reconciliation(w.recon, w.raw, _stale_staging(w))


@query
def recon_status_report(w):
    return N.status_report(N.pipeline_reconciliation(w.recon, w.raw, _stale_staging(w)))


@query
def recon_gate(w):
    return N.gate_findings(N.pipeline_reconciliation(w.recon, w.raw, _stale_staging(w)))


@query
def recon_content(w):
    """Content from lines to staging, when RAW has other descriptions each May and staging has each August; no count differs."""
    w.converted
    lines = L.good(L.parse_lines(L.read_lines(w.spark, w.landing))).where(F.col("invoice_date").isNotNull())
    path = w.scratch("raw")
    RAW.load_periods(w.spark, w.env.staged, path, w.periods, A.FIRST_LOAD)

    def altered(rows: DataFrame, month: int) -> DataFrame:
        other = (F.month("invoice_date") == month) & (F.col("stock_code").cast("bigint") % 389 == 0)
        return rows.withColumn("description", F.when(other, F.lit("altered")).otherwise(F.col("description")))

    raw = altered(RAW.read_raw(w.spark, path), 5)
    stg = altered(S.stg_orders(raw), 8)
    return N.content_reconciliation(
        K.measured_lines(lines, F.col("path_period")), K.entries(w.spark, w.env.staged), K.measured(raw), K.measured(stg)
    )


@query
def recon_vs_loaded(w):
    return N.recon_vs_loaded(w.recon_raw, w.raw)


@query
def volume_anomaly(w):
    return N.volume_anomaly(w.stg)


# ------------------------------------------------------------------------ marts


@query
def fct_order_lines(w):
    return M.fct_order_lines(w.stg)


@query
def fct_orders(w):
    return M.fct_orders(w.lines)


@query
def orders_avg_line_value(w):
    return M.with_avg_line_value(w.orders).select("invoice_no", "line_item_count", "total_revenue", "avg_line_value")


@query
def fct_revenue_monthly(w):
    return M.fct_revenue_monthly(w.orders)


@query
def dim_customer(w):
    return M.dim_customer(w.lines)


@query
def dim_customer_ranged(w):
    """The same dimension with another number of ranges under its segments."""
    return M.dim_customer(w.lines, partitions=7)


@query
def customer_country_mode(w):
    return M.customer_country(w.lines)


@query
def customer_segment_sizes(w):
    return w.customers.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.min("total_revenue").alias("lowest_revenue"),
        F.max("total_revenue").alias("highest_revenue"),
    )


@query
def dim_product(w):
    return M.dim_product(w.lines)


@query
def product_description_mode(w):
    return M.product_description(w.lines)


def _countries(w):
    countries = S.stg_worldbank_countries(w.raw_countries)
    indicators = S.stg_worldbank_indicators(w.raw_indicators)
    return M.dim_country(w.mapping, countries, indicators, w.lines)


@query
def dim_country(w):
    return _countries(w)


@query
def dim_date(w):
    """The calendar over the span of the order dates, with the orders of each day."""
    day = F.col("invoice_date").cast("date")
    per_day = w.orders.groupBy(day.alias("date_day")).agg(F.count(F.lit(1)).alias("order_count"))
    span = per_day.agg(F.min("date_day").alias("a"), F.max("date_day").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("date_day"))
    calendar = M.calendar_days(days)
    return calendar.join(per_day, "date_day", "left").na.fill(0, ["order_count"])


@query
def date_spine(w):
    """Every day of the calendar mart, with the lines of that day."""
    day = F.col("invoice_date").cast("date")
    per_day = w.lines.groupBy(day.alias("date_day")).agg(F.count(F.lit(1)).alias("line_count"))
    first, last = w.lines.agg(F.min(day), F.max(day)).first()
    spine = M.dim_date(w.spark, str(first), str(last))
    return spine.join(per_day, "date_day", "left").select("date_day", "period", F.coalesce("line_count", F.lit(0)).alias("line_count"))


# ----------------------------------------------------------------------- reader


@query
def masked_dim_customer(w):
    return R.mask_customers(w.customers, w.env.salt)


@query
def reader_views(w):
    """Rows and distinct masked customers of every view a reader gets."""
    marts = {
        "fct_order_lines": w.lines,
        "fct_orders": w.orders,
        "fct_revenue_monthly": M.fct_revenue_monthly(w.orders),
        "dim_customer": w.customers,
        "dim_product": M.dim_product(w.lines),
        "dim_country": _countries(w),
        "dim_date": M.dim_date(w.spark),
    }
    out = None
    for name, view in R.reader_views(marts, w.env).items():
        ids = F.col("customer_id") if "customer_id" in view.columns else F.lit(None).cast("string")
        hashed = F.count_if(F.length(ids) == 64)
        part = view.agg(
            F.lit(name).alias("view_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct(ids).alias("distinct_customers"),
            hashed.alias("masked_rows"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def small_country_suppression(w):
    shown = R.suppress_small_countries(R.mask_customers(w.customers, w.env.salt), SMALL_COUNTRY)
    return shown.select("customer_id", "country", "total_orders", "total_revenue")


# ----------------------------------------------------------------- environments


def _environments(w: Warehouse) -> dict[str, dict[str, DataFrame]]:
    """dev as it is; prod without streamed lines and without two late columns."""
    dev = {
        "RAW.ORDERS": w.raw,
        "RAW.WORLDBANK_COUNTRIES": w.raw_countries,
        "RAW.WORLDBANK_INDICATORS": w.raw_indicators,
        "STAGING.COUNTRY_MAPPING": w.mapping,
    }
    prod = dev | {
        "RAW.ORDERS": w.raw.where(F.col("source_system") == BATCH).drop("source_file"),
        "STAGING.COUNTRY_MAPPING": w.mapping.where("mapping_type <> 'unmappable'").drop("note"),
    }
    return {"dev": dev, "prod": prod}


@query
def env_content_diff(w):
    """prod holds the first invoice with other quantities, and lacks the free lines of 1996-02; all else is the same.

    Row counts by table show the missing lines only, and column lists nothing.
    """
    first = w.raw.agg(F.min("invoice_no")).first()[0]
    quantity = F.col("quantity") + F.when(F.col("invoice_no") == first, 1).otherwise(0)
    free = RAW.in_periods(["1996-02"]) & (F.col("unit_price") <= 0)
    prod = w.raw.where(~free).withColumn("quantity", quantity.cast("int"))
    period = period_key("partition_year", "partition_month")
    return D.content_diff(w.raw, prod, period, ORDER_FIELDS, ("dev", "prod"), rows_per_branch=5_000)


@query
def env_row_counts(w):
    return D.row_counts(_environments(w))


@query
def env_schema_diff(w):
    envs = _environments(w)
    return D.with_filled_rows(D.schema_diff(w.spark, "dev", envs["dev"], "prod", envs["prod"]), envs)


# ------------------------------------------------------------------------ checks


@query
def check_not_null(w):
    return C.count_violations(w.raw, "raw_orders", [C.not_null(c) for c in w.raw.columns])


@query
def check_unique(w):
    """Keys that repeat, per table, with the rows they cover."""
    keys = {
        "raw_orders": (w.raw, "invoice_no"),
        "fct_order_lines": (w.lines, "stock_code"),
        "fct_orders": (w.orders, "invoice_no"),
        "dim_customer": (w.customers, "customer_id"),
    }
    out = None
    for name, (df, key) in keys.items():
        part = C.not_unique(df, [key]).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("repeated_keys"),
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows_covered"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def check_accepted_values(w):
    """Lines that are neither normal nor cancellations, and (none) of no declared type."""
    declared = C.value_counts_outside(w.stg, "line_type", LINE_TYPES)
    return C.value_counts_outside(w.stg, "line_type", LINE_TYPES[:2]).unionByName(declared)


@query
def check_relationships(w):
    """Lines whose customer is not among the regular ones, by customer."""
    regular = w.customers.where("total_orders > 8")
    return C.orphans(w.lines, "customer_id", regular, "customer_id", where=F.col("customer_id").isNotNull())


@query
def check_accepted_range(w):
    return C.count_violations(
        w.stg,
        "stg_orders",
        [
            C.accepted_range("quantity", low=1),
            C.accepted_range("unit_price", low=0),
            C.accepted_range("unit_price", low=0.01),
            C.accepted_range("line_amount", low=-1000, high=50000, where=~F.col("is_cancellation")),
            C.accepted_range("duplicate_occurrence", 1, 1),
        ],
    )


@query
def check_expression(w):
    return C.count_violations(
        w.stg,
        "stg_orders",
        [
            C.expression_is_true("quantity < 0", F.col("quantity") < 0, F.col("is_cancellation"), "warn"),
            C.expression_is_true("line_amount > 0", F.col("line_amount") > 0),
            C.expression_is_true("quantity > 0", F.col("quantity") > 0, ~F.col("is_cancellation")),
        ],
    )


@query
def check_unique_combination(w):
    return C.not_unique(w.raw, ["invoice_no", "stock_code", "quantity"])


@query
def check_cancellation_consistent(w):
    """Invoices with mixed flags, when the flag of some products is turned around."""
    turned = F.col("stock_code").cast("bigint") % 101 == 0
    lines = w.lines.withColumn("is_cancellation", F.when(turned, ~F.col("is_cancellation")).otherwise(F.col("is_cancellation")))
    return C.mixed_cancellation_flags(lines)


@query
def check_duplicate_rate(w):
    return C.duplicate_rate_outside(w.stg, DUPLICATE_LIMIT, {"1996-01": 0.05})


@query
def check_marts_dedup(w):
    """A mart that lost the lines without a description."""
    return C.marts_rows_differ(w.stg, w.lines.where(F.col("description").isNotNull()))


@query
def check_marts_dedup_strict(w):
    """A mart that lost whole years."""
    return C.marts_rows_differ(w.stg, w.lines.where(F.col("period") < "1999-01"), strict=True)


@query
def check_marts_revenue(w):
    """A mart in which some products cost 1 more."""
    raised = F.when(F.col("stock_code").cast("bigint") % 89 == 0, F.col("line_amount") + 1).otherwise(F.col("line_amount"))
    return C.marts_revenue_differs(w.stg, w.lines.withColumn("line_amount", raised), REVENUE_TOLERANCE)


@query
def check_duplicate_raw_files(w):
    return C.several_files_per_period(w.raw)


@query
def check_duplicate_raw_files_listed(w):
    return C.files_listed(w.raw)


@query
def check_double_load(w):
    """RAW in which the files of every March were loaded twice, against the files' own counts."""
    march = w.raw.where("partition_month = 3")
    in_file = w.raw.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows_in_file"))
    return C.loaded_twice(w.raw.unionByName(march), in_file)


@query
def check_unmapped_countries(w):
    return C.unmapped_countries(w.stg, w.mapping.where("mapping_type <> 'alias'"))


@query
def check_mapping_resolves(w):
    return C.unresolved_mappings(w.mapping, w.raw_countries.where("income_level_id <> 'LIC'"))


@query
def check_staging_matches_recon(w):
    return C.staging_differs_from_recon(_stale_staging(w), w.recon)


@query
def source_freshness(w):
    return C.freshness(w.raw, FRESH_AS_OF, 7, 30)


# --------------------------------------------------------------------- streaming


@query
def stream_holdback_split(w):
    batch, held = CSV.hold_back(w.raw.withColumn("event_date", F.col("invoice_date").cast("date")), HOLD_BACK_DAYS)
    both = batch.withColumn("source_system", F.lit(BATCH)).unionByName(held)
    return both.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("event_date").alias("days"),
        F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"),
    )


@query
def source_system_union(w):
    """Held-back lines and the rest brought together again in staging."""
    batch, held = CSV.hold_back(w.raw.withColumn("event_date", F.col("invoice_date").cast("date")), HOLD_BACK_DAYS)
    both = batch.withColumn("source_system", F.lit(BATCH)).unionByName(held).drop("event_date")
    return by_period(S.stg_orders(both), "source_system")


def _replayed(w: Warehouse, batch: DataFrame, *held: DataFrame, max_files: int) -> tuple[DataFrame, DataFrame]:
    """Staging and the audit after a replay; each part of ``held`` arrives before a run with a checkpoint of its own."""
    names = ("stream", "raw", "stream_raw", "stg", "stream_aside", "stream_audit")
    folder, raw, stream_raw, stg, aside, audit = (w.scratch(x) for x in names)
    write_periods(batch.select(*w.raw.columns), raw, RAW.PARTITION, rebalance=False)
    S.build_stg_orders(RAW.read_raw(w.spark, raw), stg)
    for part in held:
        CSV.write_daily(part.withColumn("event_date", F.col("invoice_date").cast("date")), folder)
        checkpoint = w.scratch("checkpoint")
        replay(w.spark, folder, raw, stream_raw, stg, checkpoint, aside, audit, max_files=max_files, loaded_at=A.SECOND_LOAD)
    return S.read_stg(w.spark, stg), read_stream_audit(w.spark, audit)


@query
def stream_replay(w):
    """The held-back days arrive as a stream; staging ends up as if all had been batch."""
    dated = w.raw.withColumn("event_date", F.col("invoice_date").cast("date"))
    batch, held = CSV.hold_back(dated, HOLD_BACK_DAYS)
    stg, _ = _replayed(w, batch.withColumn("source_system", F.lit(BATCH)), held, max_files=10)
    return by_period(stg, "source_system")


@query
def stream_late_lines(w):
    """The second load arrives late, as a stream, for periods already built."""
    first = F.col("loaded_at") == F.lit(A.FIRST_LOAD)
    late = w.raw.where(~first).withColumn("source_system", F.lit(STREAM))
    stg, _ = _replayed(w, w.raw.where(first), late, max_files=2000)
    return by_period(stg)


@query
def stream_second_checkpoint(w):
    """Late lines of even days arrive, then the checkpoint is lost and the odd days arrive: all files are read again."""
    first = F.col("loaded_at") == F.lit(A.FIRST_LOAD)
    late = w.raw.where(~first).withColumn("source_system", F.lit(STREAM))
    even = F.dayofmonth("invoice_date") % 2 == 0
    stg, _ = _replayed(w, w.raw.where(first), late.where(even), late.where(~even), max_files=2000)
    return by_period(stg)


@query
def stream_batch_recon(w):
    """What the audit of a replay says of all its batches."""
    dated = w.raw.withColumn("event_date", F.col("invoice_date").cast("date"))
    batch, held = CSV.hold_back(dated, HOLD_BACK_DAYS)
    _, audit = _replayed(w, batch.withColumn("source_system", F.lit(BATCH)), held, max_files=10)
    return audit.agg(
        *[F.sum(c).alias(c) for c in ("source_lines", "rows_written", "repeated_rows", "difference")],
        F.bool_and("balanced").alias("balanced"),
    )


# ------------------------------------------------------------------ whole run


@query
def full_run(w):
    """Every period from the landing zone to the marts: how the run ended and what the reconciliation then shows."""
    _, report = w.finished
    return report.table().withColumn("run_state", F.lit(report.state))


@query
def full_run_tables(w):
    """How the whole run ended, and the rows of its tables as a SQL user sees them."""
    env, report = w.finished
    found = catalog.tables(w.spark, env)
    names = ("raw_orders", "stg_orders", "fct_order_lines", "fct_orders", "fct_revenue_monthly", "dim_customer", "dim_product")
    out = None
    for name in (*names, "dim_country", "stg_glue_recon", "fct_pipeline_reconciliation"):
        part = found[name].agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), F.lit(report.state).alias("state"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def declared_checks(w):
    """Every declared check on the tables of the whole run."""
    return P.declared_checks(catalog.tables(w.spark, w.finished[0]))
