import pytest
from conftest import dicts
from pyspark.sql import functions as F

from linetally.operators import checks as C
from linetally.operators import diff as D
from linetally.plans import marts as M
from linetally.plans import pipeline as P
from linetally.plans import staging as S


def frame(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


def test_row_checks_pass_null_and_share_one_scan(spark):
    df = frame(spark, "v string, n int", ("a", 1), ("b", 5), (None, None), ("z", -1))
    checks = [
        C.not_null("v"),
        C.not_null("v", where=F.col("n").isNotNull()),
        C.accepted_values("v", ["a", "b"]),
        C.accepted_range("n", 0, 4),
        C.accepted_range("n", low=-1),
        C.accepted_range("n", low=0, where=F.col("v") != "z"),
        C.expression_is_true("n < 5", F.col("n") < 5, severity="warn"),
    ]
    counts = C.count_violations(df, "t", checks)
    assert [r.violations for r in counts.collect()] == [1, 0, 1, 2, 0, 0, 1]
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert [r.v for r in C.violating_rows(df, checks[2]).collect()] == ["z"]


def test_severity(spark):
    df = frame(spark, "n int", (1,), (-1,))
    warn = C.count_violations(df, "t", [C.expression_is_true("n > 0", F.col("n") > 0, severity="warn")])
    assert len(C.enforce_counts(warn)) == 1
    with pytest.raises(C.CheckFailed, match=r"t.accepted_range\(n\): 1"):
        C.enforce_counts(C.count_violations(df, "t", [C.accepted_range("n", low=0)]))
    with pytest.raises(C.CheckFailed):
        C.enforce(df, "any")
    assert C.enforce(df, "any", severity="warn") == 2 and C.enforce(df.limit(0), "none") == 0


def test_unique(spark):
    df = frame(spark, "a string, b int", ("x", 1), ("x", 2), (None, 1), (None, 1))
    # a NULL single key is no key, in a combination it is a value
    assert dicts(C.not_unique(df, ["a"])) == [{"a": "x", "row_count": 2}]
    assert dicts(C.not_unique(df, ["a", "b"])) == [{"a": None, "b": 1, "row_count": 2}]


def test_accepted_values_lists_values(spark):
    df = frame(spark, "v string", ("a",), ("z",), ("z",), (None,))
    assert dicts(C.value_counts_outside(df, "v", ["a"])) == [{"value": "z", "row_count": 2}]


def test_orphans(spark):
    child = frame(spark, "k string, f boolean", ("a", True), ("b", True), ("b", True), ("c", False), (None, True))
    parent = frame(spark, "id string", ("a",), (None,))
    assert dicts(C.orphans(child, "k", parent, "id"), "key") == [
        {"key": "b", "row_count": 2},
        {"key": "c", "row_count": 1},
    ]
    assert dicts(C.orphans(child, "k", parent, "id", where=F.col("f"))) == [{"key": "b", "row_count": 2}]


def test_mixed_cancellation_flags(spark):
    df = frame(spark, "invoice_no string, is_cancellation boolean", ("1", True), ("1", False), ("2", True), ("2", True))
    assert dicts(C.mixed_cancellation_flags(df)) == [{"invoice_no": "1", "distinct_flag_values": 2}]


def test_duplicate_rate_band_and_exception(spark):
    rows = [("2010-12", i) for i in [1] * 6 + [2] * 4] + [("2011-01", i) for i in [1] * 9 + [2]] + [("2011-02", 1)]
    df = frame(spark, "period string, duplicate_occurrence int", *rows)
    out = C.duplicate_rate_outside(df, 0.05, {"2010-12": 0.45})
    assert dicts(out) == [
        {"period": "2011-01", "total_rows": 10, "duplicate_rows": 1, "duplicate_rate": 0.1, "period_class": "ordinary period"}
    ]
    assert dicts(C.duplicate_rate_outside(df, 0.2, {"2010-12": 0.35}))[0]["period_class"] == "known exception"


@pytest.fixture
def star(raw_frame):
    from datetime import datetime

    stg = S.stg_orders(raw_frame({}, {}, {"quantity": 7}, {"invoice_date": datetime(2011, 2, 3)}))
    return stg, M.fct_order_lines(stg)


def test_mart_matches_staging(star):
    stg, lines = star
    for strict in (False, True):
        assert C.marts_rows_differ(stg, lines, strict).count() == 0
        assert C.marts_revenue_differs(stg, lines, 0.01, strict).count() == 0


def test_mart_that_lost_rows(star):
    stg, lines = star
    assert dicts(C.marts_rows_differ(stg, lines.where("quantity = 6"))) == [
        {"period": "2011-01", "staging_count": 2, "marts_count": 1, "diff": 1}
    ]
    # a period that is gone altogether only shows in the strict form
    gone = lines.where("period = '2011-01'")
    assert C.marts_rows_differ(stg, gone).count() == 0
    assert dicts(C.marts_rows_differ(stg, gone, strict=True)) == [
        {"period": "2011-02", "staging_count": 1, "marts_count": 0, "diff": 1}
    ]
    assert C.marts_revenue_differs(stg, gone, 0.01, strict=True).count() == 1


def test_mart_with_other_amounts(star):
    stg, lines = star
    more = lines.withColumn("line_amount", F.col("line_amount") + F.lit(0.02))
    less = lines.withColumn("line_amount", F.col("line_amount") + F.lit(0.002))
    assert C.marts_revenue_differs(stg, more, 0.01).count() == 2
    assert C.marts_revenue_differs(stg, less, 0.01).count() == 0


def test_country_checks(spark):
    stg = frame(spark, "country string", ("France",), ("France",), ("Oz",), (None,))
    mapping = frame(
        spark,
        "retail_country string, worldbank_country_id string, mapping_type string",
        ("France", "FRA", "exact"), ("West Indies", None, "unmappable"), ("Malta", "MLT", "exact"), ("Bad", None, "alias"),
    )
    assert sorted(str(r.country) for r in C.unmapped_countries(stg, mapping).collect()) == ["None", "Oz"]
    wb = frame(spark, "country_id string", ("FRA",), ("WLD",))
    assert sorted(r.retail_country for r in C.unresolved_mappings(mapping, wb).collect()) == ["Bad", "Malta"]


def test_staging_against_recon(spark):
    stg = frame(spark, "period string", ("a",), ("a",), ("b",), ("c",))
    recon = frame(spark, "period string, rows_written_back bigint", ("a", 2), ("b", 2), ("d", 4), ("e", None))
    assert dicts(C.staging_differs_from_recon(stg, recon), "period") == [
        {"period": "b", "staging_rows": 1, "glue_rows": 2, "difference": -1},
        {"period": "c", "staging_rows": 1, "glue_rows": None, "difference": 1},
        {"period": "d", "staging_rows": None, "glue_rows": 4, "difference": -4},
    ]


def test_freshness(spark):
    df = frame(spark, "t string", ("2011-01-01 00:00:00",)).select(F.col("t").cast("timestamp").alias("loaded_at"))

    def state(as_of):
        return C.freshness(df, as_of, 7, 30).first().state

    assert [state(f"2011-01-{d}") for d in ("05", "08", "09", "31")] == ["pass", "pass", "warn", "warn"]
    assert state("2011-02-01") == "error"
    assert C.freshness(df.limit(0), "2011-01-05", 7, 30).first().state == "error"


def test_every_declared_check_names_real_columns(spark):
    stg = spark.createDataFrame([], S.STG_ORDER)
    lines = M.fct_order_lines(stg)
    orders = M.fct_orders(lines)
    tables = {
        "stg_orders": stg,
        "fct_order_lines": lines,
        "fct_orders": orders,
        "fct_revenue_monthly": M.fct_revenue_monthly(orders),
        "dim_product": M.dim_product(lines),
        "dim_date": M.dim_date(spark),
    }
    declared = P.row_checks()
    for name, df in tables.items():
        counts = C.count_violations(df, name, declared[name])
        assert counts.count() == len(declared[name])
    assert sum(map(len, declared.values())) >= 50


def test_environment_diff(spark):
    dev = {"T": frame(spark, "a string, b int", ("x", 1), ("y", None)), "U": frame(spark, "c string", ("z",))}
    prod = {"T": frame(spark, "a string, b bigint", ("x", 1)), "U": frame(spark, "c string", ("z",))}
    envs = {"dev": dev, "prod": prod}
    diff = D.with_filled_rows(D.schema_diff(spark, "dev", dev, "prod", prod), envs)
    assert dicts(diff, "only_in") == [
        {"only_in": "dev", "obj": "T", "column_name": "b", "data_type": "int", "filled_rows": 1},
        {"only_in": "prod", "obj": "T", "column_name": "b", "data_type": "bigint", "filled_rows": 1},
    ]
    assert [(r.obj, r.env, r.row_count) for r in D.row_counts(envs).collect()] == [
        ("T", "dev", 2),
        ("T", "prod", 1),
        ("U", "dev", 1),
        ("U", "prod", 1),
    ]


def test_files_of_a_period_as_one_text(raw_frame):
    raw = raw_frame({"source_file": "b"}, {"source_file": "a"}, {"source_file": "a"}, {"source_file": "c", "partition_month": 2})
    assert [tuple(r) for r in C.files_listed(raw).collect()] == [("2011-01", 2, "a, b")]
