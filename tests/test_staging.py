from datetime import datetime

import pytest
from conftest import dicts
from pyspark.sql import functions as F

from linetally.plans import staging as S

JAN, FEB = datetime(2011, 1, 4, 10), datetime(2011, 2, 4, 10)
L1, L2 = datetime(2011, 3, 1), datetime(2011, 3, 2)


def summary(spark, table):
    return sorted(
        (r.period, r.quantity, r.duplicate_occurrence) for r in S.read_stg(spark, table).collect()
    )


def test_copies_are_numbered_by_load_not_dropped(raw_frame):
    raw = raw_frame(
        {"loaded_at": L2, "customer_id": "2", "description": "b"},
        {"loaded_at": L1, "customer_id": "1", "description": "a"},
        {"loaded_at": L1, "quantity": 7},
    )
    got = {(r.customer_id, r.quantity, r.duplicate_occurrence) for r in S.stg_orders(raw).collect()}
    # the key leaves out customer, country and description
    assert got == {("1", 6, 1), ("2", 6, 2), ("17850", 7, 1)}


def test_null_key_parts_group_together(raw_frame):
    raw = raw_frame({"stock_code": None}, {"stock_code": None}, {"unit_price": None, "stock_code": None})
    assert sorted(r.duplicate_occurrence for r in S.stg_orders(raw).collect()) == [1, 1, 2]


def test_numbers_do_not_depend_on_buckets_or_hot_keys(raw_frame, spark, tmp_path):
    rows = [{"loaded_at": L1}] * 60 + [{"loaded_at": L2, "description": "z"}] * 40
    rows += [{"invoice_no": str(i), "invoice_date": FEB} for i in range(30)]
    raw_frame(*rows).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    want = sorted(map(str, S.stg_orders(raw).collect()))
    assert sorted(map(str, S.stg_orders(raw, one_task_rows=20, rows_per_bucket=8).collect())) == want
    assert sorted(r.duplicate_occurrence for r in S.stg_orders(raw).where("invoice_no = '536365'").collect()) == list(
        range(1, 101)
    )


def test_bucket_counts_follow_period_sizes(raw_frame):
    raw = raw_frame(*[{"invoice_date": JAN}] * 9, {"invoice_date": FEB})
    _, tasks = S.period_buckets(raw, rows_per_bucket=3)
    buckets, _ = S.period_buckets(raw, rows_per_bucket=3)
    sizes = {r.period: r.b for r in S.clean_lines(raw).select("period", buckets.alias("b")).distinct().collect()}
    assert sizes == {"2011-01": 4, "2011-02": 1} and tasks >= 1


def test_cleaning(raw_frame):
    row = S.stg_orders(raw_frame({"description": "  x y ", "country": " EIRE ", "invoice_no": "C9", "quantity": -2})).first()
    assert (row.description, row.country, row.is_cancellation, row.line_type) == ("x y", "EIRE", True, "cancellation")
    assert row.line_amount == pytest.approx(-5.1) and row.period == "2011-01"
    assert row.invoice_date_only == JAN.date() and row.invoice_date == JAN


def test_late_file_adds_to_its_period(spark, raw_frame, tmp_path):
    table = str(tmp_path / "stg")
    first = raw_frame({"quantity": 1, "loaded_at": L1}, {"quantity": 5, "invoice_date": FEB, "loaded_at": L1})
    assert S.refresh_stg_orders(spark, first, table) == ["2011-01", "2011-02"]
    late = first.unionByName(raw_frame({"quantity": 2, "loaded_at": L2}, {"quantity": 1, "loaded_at": L2}))
    assert S.refresh_stg_orders(spark, late, table) == ["2011-01"]
    assert summary(spark, table) == [
        ("2011-01", 1, 1),
        ("2011-01", 1, 2),
        ("2011-01", 2, 1),
        ("2011-02", 5, 1),
    ]
    # nothing new: nothing is touched
    assert S.refresh_stg_orders(spark, late, table) == []


def test_reprocess_replaces_and_empties_periods(spark, raw_frame, tmp_path):
    table = str(tmp_path / "stg")
    S.build_stg_orders(raw_frame({"quantity": 1}, {"quantity": 2}, {"quantity": 5, "invoice_date": FEB}), table)
    corrected = raw_frame({"quantity": 9})
    S.refresh_stg_orders(spark, corrected, table, ["2011-01"])
    assert summary(spark, table) == [("2011-01", 9, 1), ("2011-02", 5, 1)]
    S.refresh_stg_orders(spark, corrected, table, ["2011-02"])
    assert summary(spark, table) == [("2011-01", 9, 1)]


def test_period_rebuild_equals_full_rebuild(spark, raw_frame, tmp_path):
    rows = [{"quantity": q, "invoice_date": d} for d in (JAN, FEB) for q in (1, 1, 2)]
    raw = raw_frame(*rows)
    full, parts = str(tmp_path / "full"), str(tmp_path / "parts")
    S.build_stg_orders(raw, full)
    for period in ("2011-01", "2011-02"):
        S.rebuild_periods(spark, raw, parts, [period])
    assert summary(spark, full) == summary(spark, parts)


def test_schema_drift_stops_the_write(spark, raw_frame, tmp_path):
    table = str(tmp_path / "stg")
    S.build_stg_orders(raw_frame({}), table)
    drifted = S.stg_orders(raw_frame({})).withColumn("channel", F.lit("web"))
    with pytest.raises(S.SchemaDriftError, match="channel"):
        S._write_stg(drifted, table, spark)
    with pytest.raises(S.SchemaDriftError, match="quantity"):
        S._write_stg(S.stg_orders(raw_frame({})).withColumn("quantity", F.lit(1.0)), table, spark)
    assert summary(spark, table) == [("2011-01", 6, 1)]


def test_countries_drop_aggregates_and_clean(spark):
    ddl = (
        "country_id string, iso2_code string, country_name string, region_id string, region_name string, "
        "income_level_id string, income_level_name string, lending_type_id string, capital_city string, "
        "longitude string, latitude string, source_system string, ingested_at timestamp, loaded_at timestamp"
    )
    fill = ("a", "b")

    def row(country, region, capital=" Paris ", lon="2.3"):
        return (country, *fill, region, "r", "i", "n", "l", capital, lon, "", "s", L1, L1)

    raw = spark.createDataFrame(
        [row("FRA", "ECS"), row("WLD", "NA"), row("XXX", None), row("NAM", "SSF", "  ", "n/a")], ddl
    )
    got = dicts(S.stg_worldbank_countries(raw).select("country_id", "capital_city", "longitude", "latitude"), "country_id")
    assert got == [
        {"country_id": "FRA", "capital_city": "Paris", "longitude": 2.3, "latitude": None},
        {"country_id": "NAM", "capital_city": None, "longitude": None, "latitude": None},
    ]


def test_indicators_pivot(spark):
    gdp, pop = "NY.GDP.MKTP.CD", "SP.POP.TOTL"
    rows = [
        ("FRA", gdp, "2010", 100.0), ("FRA", pop, "2010", 4.0),
        ("FRA", gdp, "2011", 120.0),
        ("ZZZ", gdp, "2010", 5.0), ("ZZZ", pop, "2010", 0.0),
        ("NUL", gdp, "2010", None), ("NUL", pop, "2010", 2.0),
        (None, gdp, "2010", 9.0),
    ]
    raw = spark.createDataFrame(rows, "country_id string, indicator_id string, year string, value double")
    raw = raw.withColumns({"source_system": F.lit("s"), "ingested_at": F.lit(L1), "loaded_at": F.lit(L1)})
    got = {
        (r.country_id, r.year): (r.gdp_usd, r.population, r.gdp_per_capita_usd)
        for r in S.stg_worldbank_indicators(raw).collect()
    }
    assert got == {
        ("FRA", "2010"): (100.0, 4.0, 25.0),
        ("FRA", "2011"): (120.0, None, None),
        ("ZZZ", "2010"): (5.0, 0.0, None),
        ("NUL", "2010"): (None, 2.0, None),
    }


def test_reprocess_does_not_hide_periods_loaded_before(spark, raw_frame, tmp_path):
    table = str(tmp_path / "stg")
    S.refresh_stg_orders(spark, raw_frame({"loaded_at": L1}), table)
    # 2010-11 and 2011-02 are loaded later; one is reprocessed by name before the incremental run
    late = [{"loaded_at": L2, "invoice_date": datetime(2010, 11, 3)}, {"loaded_at": L2, "invoice_date": FEB}]
    raw = raw_frame({"loaded_at": L1}, *late)
    S.refresh_stg_orders(spark, raw, table, ["2011-02"])
    assert S.refresh_stg_orders(spark, raw, table) == ["2010-11"]
    assert [p for p, _, _ in summary(spark, table)] == ["2010-11", "2011-01", "2011-02"]
    # fewer rows in RAW are seen, too
    assert S.refresh_stg_orders(spark, raw_frame({"loaded_at": L1}), table) == ["2010-11", "2011-02"]
    assert [p for p, _, _ in summary(spark, table)] == ["2011-01"]


def test_only_stored_and_cleaned_columns_are_shuffled(raw_frame):
    plan = S.stg_orders(raw_frame({}, {"quantity": -1}))._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression", 1)
    for derived in ("line_amount", "line_type", "invoice_date_only", "is_cancellation"):
        assert f"AS {derived}#" in above and f"AS {derived}#" not in below


def test_tasks_stay_small_enough_to_sort_in_memory(spark):
    raw = spark.range(1_000_000).selectExpr("2011 AS partition_year", "1 AS partition_month")
    _, tasks = S.period_buckets(raw)
    assert tasks >= 4
