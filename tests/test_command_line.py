import json

import pytest

from linetally.__main__ import main
from linetally.env import Env
from linetally.plans import catalog
from linetally.plans.convert import ConversionError

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"


@pytest.fixture
def shop(spark, tmp_path):
    csv = tmp_path / "orders.csv"
    csv.write_text(
        "\n".join(
            [
                HEADER,
                "1,a,Mug,2,2011-01-04 10:00:00,1.5,10.0,France",
                "1,a,Mug,2,2011-01-04 10:00:00,1.5,10.0,France",
                "C2,a,Mug,-1,2011-01-05 10:00:00,1.5,10.0,France",
                "3,b,Pen,5,2011-02-01 10:00:00,1.0,,EIRE",
                "4,b,Pen,5,sometime,1.0,,EIRE",
            ]
        )
        + "\n"
    )
    base = tmp_path / "base"

    def run(*args):
        return main(["--base", str(base), "--salt", "s", *args])

    run.csv, run.env, run.tmp = str(csv), Env("dev", str(base), "s"), tmp_path
    return run


def reference(shop):
    for dataset, record in {
        "countries": {"id": "FRA", "name": "France", "region": {"id": "ECS", "value": "Europe"}},
        "gdp": {"countryiso3code": "FRA", "indicator": {"id": "NY.GDP.MKTP.CD"}, "date": "2010", "value": 10.0},
        "population": {"countryiso3code": "FRA", "indicator": {"id": "SP.POP.TOTL"}, "date": "2010", "value": 5},
    }.items():
        folder = shop.tmp / "pages" / f"dataset={dataset}"
        folder.mkdir(parents=True)
        (folder / "1.json").write_text(json.dumps([{"page": 1, "pages": 1}, [record]]))
    shop("reference", "--pages", str(shop.tmp / "pages"))
    shop("seed")


def test_from_csv_to_sql(spark, shop, capsys):
    shop("land", "--input", shop.csv)
    assert "1 lines have no usable date" in capsys.readouterr().out
    reference(shop)
    assert shop("run", "2011-01", "2011-02") == 0
    names = catalog.register(spark, shop.env)
    assert {"raw_orders", "stg_orders", "fct_orders", "dim_country", "fct_pipeline_reconciliation"} <= set(names)
    got = spark.sql(
        "select country, total_orders, total_revenue, cancelled_orders from fct_revenue_monthly order by period, country"
    ).collect()
    assert [tuple(r) for r in got] == [("France", 1, 3.0, 1), ("EIRE", 1, 5.0, 0)]
    assert spark.sql("select distinct recon_status from fct_pipeline_reconciliation").collect()[0][0] == "ok"
    shop("--preview", "20", "report")
    shop("--preview", "20", "sql", "select stock_code, cancellation_rate from dim_product order by 1")
    out = capsys.readouterr().out
    assert "SUCCESS" in out and "0.33" in out


def test_single_steps(spark, shop, capsys):
    shop("land", "--input", shop.csv, "--stream-days", "1")
    shop("convert", "--year", "2011", "--month", "1")
    with pytest.raises(ConversionError, match="2011-02: no_source_lines"):
        shop("backfill", "2011-01", "2011-02")
    shop("load")
    shop("load")
    out = capsys.readouterr().out
    assert "1 files loaded" in out and "0 files loaded" in out
    shop("stage")
    # the held-back day arrives as a stream
    shop("replay")
    stg = catalog.tables(spark, shop.env)["stg_orders"]
    assert sorted((r.period, r.invoice_no, r.source_system) for r in stg.collect()) == [
        ("2011-01", "1", "batch_historical"),
        ("2011-01", "1", "batch_historical"),
        ("2011-01", "C2", "batch_historical"),
        ("2011-02", "3", "stream_live"),
    ]
    # reprocessing a period keeps what was streamed into it
    shop("load", "2011-01")
    shop("stage", "2011-01", "2011-02")
    assert catalog.tables(spark, shop.env)["stg_orders"].count() == 4


def test_failed_run_returns_an_error_code(shop):
    shop("land", "--input", shop.csv)
    assert shop("run", "1999-01") == 1


def test_results_are_written_in_full(spark, shop):
    shop("land", "--input", shop.csv)
    out = str(shop.tmp / "out")
    shop("--output", out, "sql", "select id from range(700)")
    assert spark.read.option("header", "true").csv(out).count() == 700
    with pytest.raises(SystemExit, match="--output"):
        shop("sql", "select 1")


def test_source_with_too_few_dates_stops(shop):
    with pytest.raises(ValueError, match="usable date"):
        shop("land", "--input", shop.csv, "--most-undated", "0.1")


def test_lines_set_aside_of_several_files_stay(spark, shop):
    """Landing a second file leaves what was set aside of the first; landing the first again replaces its own."""
    other = shop.tmp / "other.csv"
    other.write_bytes(open(shop.csv, "rb").read())
    for path in (shop.csv, str(other), shop.csv):
        shop("land", "--input", path)
    aside = spark.read.json(f"{shop.env.quarantine_csv}/undated")
    assert sorted(r["count"] for r in aside.groupBy("source").count().collect()) == [1, 1]
