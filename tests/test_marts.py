from datetime import date, datetime

import pytest
from conftest import dicts
from pyspark.sql import functions as F

from linetally.plans import marts as M
from linetally.plans import staging as S

D = datetime


def lines(raw_frame, *rows):
    return M.fct_order_lines(S.stg_orders(raw_frame(*rows)))


def test_copies_are_removed_once(raw_frame):
    out = lines(raw_frame, {}, {}, {"quantity": 7})
    assert sorted(r.quantity for r in out.collect()) == [6, 7]
    assert tuple(out.columns) == M.LINE_COLUMNS


def test_orders(raw_frame):
    out = M.fct_orders(
        lines(
            raw_frame,
            {"invoice_no": "1", "stock_code": "a", "quantity": 2, "unit_price": 1.5},
            {"invoice_no": "1", "stock_code": "a", "quantity": 3, "unit_price": 1.5},
            {"invoice_no": "1", "stock_code": "b", "quantity": 1, "unit_price": 0.1, "customer_id": None},
            {"invoice_no": "C2", "quantity": -1, "unit_price": 4.0},
        )
    )
    got = {r.invoice_no: r for r in out.collect()}
    assert (got["1"].line_item_count, got["1"].total_quantity, got["1"].total_revenue) == (2, 6, 7.6)
    assert got["1"].customer_id == "17850" and not got["1"].is_cancelled_order
    assert got["C2"].is_cancelled_order and got["C2"].total_revenue == -4.0
    values = {r.invoice_no: r.avg_line_value for r in M.with_avg_line_value(out).collect()}
    assert values == {"1": 3.8, "C2": -4.0}


def test_revenue_monthly_changes(raw_frame):
    def order(no, month, price, country="France", **more):
        return {"invoice_no": no, "invoice_date": D(2011, month, 3), "unit_price": price, "quantity": 1, "country": country} | more

    out = M.fct_revenue_monthly(
        M.fct_orders(
            lines(
                raw_frame,
                order("1", 1, 10.0),
                order("2", 1, 5.0, customer_id=None),
                order("C3", 1, 4.0, quantity=-1),
                order("4", 2, 30.0),
                # April follows February: March has no rows
                order("5", 4, 0.0),
                order("6", 5, 7.0),
                order("7", 2, 1.0, country="Spain"),
            )
        )
    )
    got = {(r.country, r.period): r for r in out.collect()}
    jan, feb = got["France", "2011-01"], got["France", "2011-02"]
    assert (jan.total_orders, jan.total_revenue, jan.total_units, jan.total_customers) == (2, 15.0, 2, 1)
    assert (jan.cancelled_orders, jan.cancelled_revenue) == (1, 4.0)
    assert (jan.prior_period_revenue, jan.revenue_mom_change, jan.is_first_period_for_country) == (None, None, True)
    assert (feb.prior_period_revenue, feb.revenue_mom_change, feb.is_first_period_for_country) == (15.0, 1.0, False)
    april = got["France", "2011-04"]
    assert (april.prior_period_revenue, april.revenue_mom_change) == (30.0, -1.0)
    may = got["France", "2011-05"]
    assert (may.prior_period_revenue, may.revenue_mom_change, may.is_first_period_for_country) == (0.0, 0.0, False)
    assert got["Spain", "2011-02"].is_first_period_for_country


def test_customers(raw_frame):
    fact = lines(
        raw_frame,
        {"customer_id": "a", "invoice_no": "1", "invoice_date": D(2011, 1, 1, 23, 59), "unit_price": 2.0, "quantity": 5, "country": "France"},
        {"customer_id": "a", "invoice_no": "1", "invoice_date": D(2011, 1, 1, 23, 59), "unit_price": 1.0, "quantity": 1, "country": "Spain", "stock_code": "x"},
        {"customer_id": "a", "invoice_no": "2", "invoice_date": D(2011, 1, 2, 0, 1), "unit_price": 1.0, "quantity": 1, "country": "France"},
        {"customer_id": "a", "invoice_no": "C3", "invoice_date": D(2011, 1, 2, 0, 1), "unit_price": 2.0, "quantity": -5, "country": "Spain"},
        {"customer_id": "b", "invoice_no": "C4", "invoice_date": D(2011, 1, 4), "quantity": -1},
        {"customer_id": None, "invoice_no": "5", "invoice_date": D(2011, 6, 1)},
    )
    got = {r.customer_id: r for r in M.dim_customer(fact).collect()}
    assert set(got) == {"a", "b"}
    a, b = got["a"], got["b"]
    # a tie of two lines each: the smaller name
    assert a.country == "France"
    # two minutes over midnight are a day
    assert a.customer_tenure_days == 1
    assert (a.total_orders, a.total_cancelled_orders, a.total_line_items) == (2, 1, 4)
    assert (a.total_units_purchased, a.total_revenue) == (7, 12.0)
    assert (a.cancellation_rate, a.avg_order_value) == (1 / 3, 6.0)
    # recency counts from the last invoice of any known customer
    assert (a.rfm_recency_days, b.rfm_recency_days) == (2, 0)
    assert (b.total_orders, b.total_revenue, b.avg_order_value, b.cancellation_rate) == (0, 0.0, None, 1.0)
    assert (b.customer_segment, a.customer_segment) == ("low_value", "mid_value")


@pytest.mark.parametrize("n", [1, 2, 4, 9])
def test_customer_segments_on_both_ways(raw_frame, n):
    fact = lines(raw_frame, *[{"customer_id": f"c{i}", "invoice_no": str(i), "unit_price": float(i // 2)} for i in range(n)])
    one = sorted(map(str, M.dim_customer(fact).collect()))
    assert sorted(map(str, M.dim_customer(fact, partitions=3).collect())) == one


def test_products(raw_frame):
    fact = lines(
        raw_frame,
        {"stock_code": "a", "description": "Mug", "quantity": 4, "unit_price": 1.0, "invoice_no": "1"},
        {"stock_code": "a", "description": "MUG", "quantity": 4, "unit_price": 2.0, "invoice_no": "2"},
        {"stock_code": "a", "description": "Mug", "quantity": -2, "unit_price": 9.0, "invoice_no": "C3"},
        {"stock_code": "p", "description": None, "quantity": -1, "unit_price": 5.0, "invoice_no": "C4"},
        {"stock_code": "n", "description": None, "quantity": -3, "unit_price": 1.0, "invoice_no": "5"},
    )
    got = {r.stock_code: r for r in M.dim_product(fact).collect()}
    a, p, n = got["a"], got["p"], got["n"]
    assert (a.description, a.total_orders_containing, a.total_units_sold, a.total_revenue) == ("Mug", 3, 8, 12.0)
    assert (a.total_cancelled_units, a.avg_unit_price, a.cancellation_rate) == (2, 1.5, 0.2)
    assert (p.description, p.avg_unit_price, p.total_cancelled_units, p.cancellation_rate) == (None, None, 1, 1.0)
    # negative adjustments count as units sold, as the model says
    assert (n.total_units_sold, n.cancellation_rate) == (-3, 0.0)


def test_country_keeps_unmappable_rows_and_one_year(spark, raw_frame):
    mapping = spark.createDataFrame(
        [("France", "FRA", "exact", None), ("West Indies", None, "unmappable", None), ("Malta", "MLT", "exact", None)],
        "retail_country string, worldbank_country_id string, mapping_type string, note string",
    )
    wb = spark.createDataFrame(
        [("FRA", "France", "Europe", "High")],
        "country_id string, country_name string, region_name string, income_level_name string",
    )
    ind = spark.createDataFrame(
        [("FRA", "2010", 100.0, 4.0, 25.0), ("FRA", "2011", 1.0, 1.0, 1.0)],
        "country_id string, year string, gdp_usd double, population double, gdp_per_capita_usd double",
    )
    fact = lines(
        raw_frame,
        {"country": "France", "unit_price": 2.0, "quantity": 1},
        {"country": "France", "invoice_no": "C1", "quantity": -1, "customer_id": "9"},
        {"country": "West Indies", "customer_id": None, "unit_price": 3.0, "quantity": 1},
    )
    got = {r.retail_country: r for r in M.dim_country(mapping, wb, ind, fact).collect()}
    assert len(got) == 3
    fr, wi, mt = got["France"], got["West Indies"], got["Malta"]
    assert (fr.country_name, fr.gdp_usd, fr.total_orders, fr.total_customers) == ("France", 100.0, 2, 2)
    assert (fr.total_revenue, fr.revenue_per_capita) == (2.0, 0.5)
    assert (wi.country_name, wi.total_orders, wi.total_customers, wi.total_revenue) == (None, 1, 0, 3.0)
    assert wi.revenue_per_capita is None
    assert (mt.total_orders, mt.total_revenue, mt.revenue_per_capita) == (0, 0.0, None)
    later = M.dim_country(mapping, wb, ind, fact, indicator_year="2011")
    assert later.where("retail_country = 'France'").first().gdp_usd == 1.0


def test_calendar(spark):
    out = M.dim_date(spark)
    days = dicts(out.where("date_day in (date'2010-01-31', date'2012-01-30', date'2011-02-28')"), "date_day")
    assert out.count() == 791 and out.agg(F.max("date_day")).first()[0] == date(2012, 1, 30)
    assert days[0] == {
        "date_day": date(2010, 1, 31), "year": 2010, "month": 1, "month_name": "January", "quarter": 1,
        "day_of_week": 0, "day_name": "Sunday", "is_weekend": True, "is_month_end": True, "period": "2010-01",
    }
    assert (days[1]["day_name"], days[1]["is_weekend"], days[1]["is_month_end"]) == ("Monday", False, True)
    assert days[2]["is_month_end"] is False


def test_order_lines_are_folded_by_hash(spark, tmp_path):
    columns = "invoice_no string, stock_code string, customer_id string, country string, period string, invoice_date timestamp_ntz, quantity int, line_amount double, is_cancellation boolean"
    spark.createDataFrame([], columns).write.parquet(str(tmp_path / "lines"))
    plan = M.fct_orders(spark.read.parquet(str(tmp_path / "lines")))._jdf.queryExecution().sparkPlan().toString()
    # from the scan up, the first aggregate is a hash aggregate
    aggregates = [line for line in plan.splitlines() if "Aggregate(" in line]
    assert "HashAggregate" in aggregates[-1] and "SortAggregate" not in aggregates[-1]


def test_lines_of_orders_are_shuffled_once(spark, raw_frame, tmp_path):
    kinds = [("a", "9", 1), ("b", "9", 2), ("b", None, 3), ("b", "9", 4)]
    rows = [{"invoice_no": no, "stock_code": s, "customer_id": c, "quantity": q} for no in ("1", "2", None) for s, c, q in kinds]
    lines(raw_frame, *rows, {"invoice_no": "3"}).write.parquet(str(tmp_path / "lines"))
    stored = spark.read.parquet(str(tmp_path / "lines"))
    orders = M.fct_orders(stored)
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    # huge invoices are folded before each shuffle, with the same result
    want = sorted(map(str, orders.collect()))
    assert sorted(map(str, M.fct_orders(stored, one_task_rows=2).collect())) == want
    assert {(r.invoice_no, r.line_item_count) for r in orders.collect()} == {("1", 2), ("2", 2), (None, 2), ("3", 1)}
