import json
from datetime import datetime
from pathlib import Path

import pytest
from conftest import landed, write_day
from pyspark.sql import functions as F

from linetally.env import Env, scratch_path, scratch_root, written
from linetally.plans import convert
from linetally.plans import pipeline as P
from linetally.plans import reader as R
from linetally.plans.staging import read_stg
from linetally.sources import reference
from linetally.sources.raw_orders import read_raw

AT = datetime(2011, 3, 1)


@pytest.fixture
def env(spark, tmp_path):
    return environment(spark, tmp_path)


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    """An environment after one run, for tests that only look."""
    env = environment(spark, tmp_path_factory.mktemp("finished"))
    return env, P.run(spark, env, ["2011-01"], AT)


def environment(spark, tmp_path):
    env = Env("dev", str(tmp_path / "dev"), "salt")
    reference.write_default_mapping(spark, env.country_mapping)
    pages = tmp_path / "pages"
    for dataset, record in {
        "countries": {"id": "GBR", "name": "United Kingdom", "region": {"id": "ECS", "value": "Europe"}},
        "gdp": {"countryiso3code": "GBR", "indicator": {"id": "NY.GDP.MKTP.CD"}, "date": "2010", "value": 10.0},
        "population": {"countryiso3code": "GBR", "indicator": {"id": "SP.POP.TOTL"}, "date": "2010", "value": 5},
    }.items():
        (pages / f"dataset={dataset}").mkdir(parents=True)
        (pages / f"dataset={dataset}" / "1.json").write_text(json.dumps([{"page": 1, "pages": 1}, [record]]))
    read = reference.read_pages(spark, str(pages))
    landing = str(tmp_path / "reference")
    reference.land_reference(
        reference.flatten_countries(read, F.lit(AT)), reference.flatten_indicators(read, F.lit(AT)), landing
    )
    reference.load_countries(spark, landing, env.raw_countries, AT)
    reference.load_indicators(spark, landing, env.raw_indicators, AT)
    for day in ("04", "05"):
        stamp = f"2011-01-{day}T10:00:00"
        write_day(env.landing, f"2011-01-{day}", landed(invoice_date=stamp), landed(invoice_date=stamp, invoice_no="C7", quantity=-1))
    write_day(env.landing, "2011-01-06", landed(invoice_date="2011-01-06T10:00:00", customer_id=None), "{bad")
    return env


def test_whole_run(spark, finished):
    env, report = finished
    assert (report.state, report.failed_step) == ("SUCCESS", None)
    row = report.table().first()
    assert (row.ndjson_source_lines, row.glue_wrote_to_s3, row.snowflake_loaded, row.dbt_staging_rows) == (6, 5, 5, 5)
    assert row.recon_status == "ok"
    marts = P.read_marts(spark, env)
    assert set(marts) == set(P.MARTS)
    # every line is written, and every written line is in exactly one place
    stg = read_stg(spark, env.stg_orders)
    assert stg.count() == marts["fct_order_lines"].count() + stg.where("duplicate_occurrence > 1").count()
    assert marts["dim_country"].count() == 43
    uk = marts["dim_country"].where("retail_country = 'United Kingdom'").first()
    assert (uk.gdp_per_capita_usd, uk.total_customers) == (2.0, 1)


def test_gate_stops_before_the_marts(spark, env, monkeypatch):
    load = P.load_periods

    def lose_a_row(spark, staged, raw, periods, loaded_at):
        load(spark, staged, raw, periods, loaded_at)
        kept = written(read_raw(spark, raw).limit(4), "kept")
        kept.write.mode("overwrite").partitionBy("partition_year", "partition_month").parquet(raw)

    monkeypatch.setattr(P, "load_periods", lose_a_row)
    report = P.run(spark, env, ["2011-01"], AT, raise_on_failure=False)
    assert (report.state, report.failed_step) == ("FAILED", "gate")
    assert report.table().first().recon_status == "s3_to_snowflake_mismatch"
    assert not Path(env.mart("fct_order_lines")).exists()


def test_failed_conversion_is_raised(spark, finished):
    with pytest.raises(convert.ConversionError):
        P.run(spark, finished[0], ["1999-01"], AT)


def test_reader_sees_rollups_with_masked_ids(spark, finished):
    env, _ = finished
    marts = P.read_marts(spark, env)
    views = R.reader_views(marts, env)
    assert set(views) == set(R.READER_TABLES) and "fct_order_lines" not in views
    for name in ("dim_customer", "fct_orders"):
        real, shown = marts[name].select("customer_id"), views[name].select("customer_id")
        assert real.distinct().count() == shown.distinct().count()
        assert not {r[0] for r in real.collect() if r[0]} & {r[0] for r in shown.collect()}
    assert spark.table("reader_dim_customer").count() == 1
    builder = R.mask_customers(marts["dim_customer"], env.salt, privileged=True)
    assert builder.first().customer_id == "17850"


def test_small_countries_are_suppressed(spark):
    df = spark.createDataFrame([("a", "UK"), ("b", "UK"), ("c", "Iceland"), ("d", None)], "customer_id string, country string")
    got = {(r.customer_id, r.country) for r in R.suppress_small_countries(df, 2).collect()}
    assert got == {("a", "UK"), ("b", "UK"), (None, "Iceland"), (None, None)}


def test_environments_have_the_same_layers():
    dev, prod = Env("dev", "/d", "s1"), Env("prod", "/p/", "s2")
    assert dev.raw_orders == "/d/raw/orders" and prod.raw_orders == "/p/raw/orders"
    assert Env("x", "/d", "s", landing_root="/l").landing == "/l"


def test_scratch_is_where_the_cluster_says(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scratch_root(spark) == configured.rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_next_month_and_rerun_leave_the_first_alone(spark, finished):
    env, _ = finished
    before = sorted(map(str, read_stg(spark, env.stg_orders).collect()))
    write_day(env.landing, "2011-02-01", landed(invoice_date="2011-02-01T10:00:00"))
    report = P.run(spark, env, ["2011-01", "2011-02"], AT)
    assert [(r.period, r.recon_status) for r in report.table().collect()] == [("2011-01", "ok"), ("2011-02", "ok")]
    january = read_stg(spark, env.stg_orders).where("period = '2011-01'")
    assert january.drop("source_file").count() == len(before)


def test_reader_views_need_a_salt(spark):
    with pytest.raises(ValueError, match="salt"):
        R.reader_views({}, Env("dev", "/d", ""))


def test_declared_checks_cover_all_tables(spark, finished):
    from linetally.plans.catalog import tables

    found = tables(spark, finished[0])
    checks = P.declared_checks(found).collect()
    assert {r.table_name for r in checks} == {*P.row_checks(), *P.UNIQUE_KEYS}
    assert all(r.violations == 0 for r in checks if r.severity == "error")
    del found["stg_glue_recon"]
    with pytest.raises(LookupError, match="stg_glue_recon"):
        P.declared_checks(found)


def test_report_after_a_failed_conversion(spark, finished):
    report = P.run(spark, finished[0], ["1999-01"], AT, raise_on_failure=False)
    assert [(r.period, r.recon_status) for r in report.table().collect()] == [("1999-01", "no_source_lines")]


def test_streamed_labels_in_the_landing_zone(spark, tmp_path):
    """Converted lines labelled as streamed are counted by the audit record like all others; lines of the stream store are not."""
    env = environment(spark, tmp_path)
    write_day(env.landing, "2011-01-07", *[landed(invoice_date="2011-01-07T10:00:00", source_system="stream_live", quantity=k + 1) for k in range(3)])
    report = P.run(spark, env, ["2011-01"], AT)
    assert (report.state, report.steps[-1], report.error) == ("SUCCESS", "checks", None)
    late = read_raw(spark, env.raw_orders).limit(2).withColumn("source_system", F.lit("stream_live"))
    late = late.withColumn("query_id", F.lit("q")).withColumn("batch_id", F.lit(0).cast("long"))
    late.write.partitionBy("partition_year", "partition_month", "query_id", "batch_id").parquet(env.raw_orders_stream)
    assert P.run(spark, env, ["2011-01"], AT).state == "SUCCESS"
    assert read_stg(spark, env.stg_orders).count() == 5 + 3 + 2


def test_all_failing_checks_are_reported_together(spark, tmp_path):
    env = environment(spark, tmp_path)
    write_day(env.landing, "2011-01-07", landed(invoice_date="2011-01-07T10:00:00", country="Atlantis", invoice_no="A9", quantity=-5, unit_price=9999.0))
    report = P.run(spark, env, ["2011-01"], AT, raise_on_failure=False)
    assert (report.state, report.failed_step) == ("FAILED", "checks")
    message = str(report.error)
    assert all(part in message for part in ("accepted_range(total_revenue)", "lines without country", "unmapped countries"))
