import json
from datetime import date
from pathlib import Path

import pytest

from linetally.sources import csv_orders as CSV
from linetally.sources.landing import good, parse_lines, read_lines

OLD = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
NEW = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"


def scan(spark, tmp_path, header, *lines):
    path = tmp_path / "orders.csv"
    path.write_text("\n".join([header, *lines]) + "\n", encoding="ISO-8859-1")
    return CSV.prepare(CSV.scan_csv(spark, str(path)))


@pytest.mark.parametrize("header", [OLD, NEW])
def test_both_headers(spark, tmp_path, header):
    row = scan(spark, tmp_path, header, '536365,85123A,"CAFÉ, SET",6,2010-12-01 08:26:00,2.55,17850.0,United Kingdom').first()
    assert (row.invoice_no, row.description, row.quantity, row.unit_price) == ("536365", "CAFÉ, SET", 6, 2.55)
    assert (row.customer_id, row.event_date, row.source_system) == ("17850", date(2010, 12, 1), "batch_historical")


def test_columns_in_any_order_and_extra_ones(spark, tmp_path):
    header = "Country,Extra,Price,Customer ID,Invoice,StockCode,Description,Quantity,InvoiceDate"
    row = scan(spark, tmp_path, header, "France,e,1.5,,1,a,,2,2010-12-01 08:26:00").first()
    assert (row.country, row.unit_price, row.customer_id, row.description) == ("France", 1.5, None, None)


def test_missing_column_names_what_was_found(spark, tmp_path):
    with pytest.raises(ValueError, match=r"country.*\['InvoiceNo'"):
        scan(spark, tmp_path, OLD.removesuffix(",Country"), "1,a,b,1,2010-12-01,1,1")


ROWS = [
    "1,a,x,1,2010-12-01 08:00:00,1.0,10,UK",
    "1,a,x,1,2010-12-01 08:00:00,1.0,10,UK",
    "C2,a,x,-1,2010-12-02 08:00:00,1.0,,UK",
    "3,b,y,1,2010-12-05 08:00:00,0.0,11,France",
    "4,b,y,1,someday,1.0,11,France",
]


def test_profile_and_undated(spark, tmp_path):
    dated, undated = CSV.split_undated(scan(spark, tmp_path, OLD, *ROWS))
    assert [r.invoice_no for r in undated.collect()] == ["4"]
    assert CSV.profile(dated).first().asDict() == {
        "row_count": 4,
        "first_date": date(2010, 12, 1),
        "last_date": date(2010, 12, 5),
        "distinct_invoices": 3,
        "distinct_customers": 2,
        "distinct_countries": 2,
        "null_customer_id": 1,
        "negative_quantity": 1,
        "non_positive_price": 1,
        "cancellations": 1,
        "exact_duplicates": 1,
        "null_customer_share": 0.25,
    }
    assert CSV.profile(dated.limit(0)).first().null_customer_share is None


def test_hold_back_counts_days_that_exist(spark, tmp_path):
    dated, _ = CSV.split_undated(scan(spark, tmp_path, OLD, *ROWS))
    batch, held = CSV.hold_back(dated, 2)
    assert {r.invoice_no for r in held.collect()} == {"C2", "3"} and batch.count() == 2
    assert {r.source_system for r in held.collect()} == {"stream_live"}
    assert CSV.hold_back(dated, 3)[0].count() == 0
    for days in (0, 4):
        with pytest.raises(ValueError, match="hold back"):
            CSV.hold_back(dated, days)


def test_daily_files(spark, tmp_path):
    dated, _ = CSV.split_undated(scan(spark, tmp_path, OLD, *ROWS))
    root = tmp_path / "batch"
    for _ in range(2):  # the days are replaced, not added to
        CSV.write_daily(dated, str(root))
    folders = sorted(p.name for p in root.glob("event_date=*"))
    assert folders == ["event_date=2010-12-01", "event_date=2010-12-02", "event_date=2010-12-05"]
    line = json.loads(next(Path(root, folders[1]).glob("*.json")).read_text())
    assert list(line) == CSV.LANDED_ORDER.fieldNames()  # no event_date in the body
    assert line["customer_id"] is None and line["invoice_date"] == "2010-12-02T08:00:00"
    back = good(parse_lines(read_lines(spark, str(root))))
    assert back.count() == 4 and back.where("ingested_at is null").count() == 0


def test_month_first_dates_and_quoted_line_breaks(spark, tmp_path):
    rows = [
        '1,a,"TWO\nLINES",6,12/1/2010 8:26,2.55,17850,United Kingdom',
        '2,a,"say ""hi"", twice",1,1/12/2011 14:05:09,1.0,,UK',
        "3,a,x,1,1/2/2011,1.0,,UK",
        "4,a,x,1,13/1/2011 8:00,1.0,,UK",
        "5,a,x,1,17850,1.0,,UK",
    ]
    got = {r.invoice_no: r for r in scan(spark, tmp_path, OLD, *rows).collect()}
    assert got["1"].description == "TWO\nLINES" and str(got["1"].invoice_date) == "2010-12-01 08:26:00"
    assert got["2"].description == 'say "hi", twice' and str(got["2"].invoice_date) == "2011-01-12 14:05:09"
    assert str(got["3"].invoice_date) == "2011-01-02 00:00:00"
    assert got["4"].invoice_date is None and got["5"].invoice_date is None


def test_malformed_rows_are_set_aside(spark, tmp_path):
    good, short, long = "1,a,x,1,2010-12-01 08:00:00,1.0,10,UK", "2,a,x,1,2010-12-01", good_and_more()
    assert [r.invoice_no for r in scan(spark, tmp_path, OLD, good, short, long).collect()] == ["1"]
    aside = CSV.malformed_rows(CSV.scan_csv_rows(spark, str(tmp_path / "orders.csv"))).collect()
    assert sorted(r.line for r in aside) == sorted([short, long]) and {r.reason for r in aside} == {"malformed"}


def good_and_more():
    return "3,a,x,1,2010-12-01 08:00:00,1.0,10,UK,more"


def test_too_many_undated_rows_are_an_error():
    CSV.require_dated(95, 5, 0.05)
    with pytest.raises(ValueError, match="6 of 100"):
        CSV.require_dated(94, 6, 0.05)
