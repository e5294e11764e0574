import json
from datetime import datetime

import pytest
from conftest import dicts
from pyspark.sql import functions as F

from linetally.fixed_values import COUNTRY_MAPPING
from linetally.sources import reference as R

AT = datetime(2011, 1, 1)


def country(id_, region="ECS", **more):
    return {
        "id": id_, "iso2Code": id_[:2], "name": f"Land {id_}", "region": {"id": region, "iso2code": "Z", "value": "Reg"},
        "adminregion": {"id": "", "value": ""}, "incomeLevel": {"id": "HIC", "value": "High"},
        "lendingType": {"id": "LNX"}, "capitalCity": "Town", "longitude": "1.5", "latitude": "",
    } | more


def figure(id_, value, code="NY.GDP.MKTP.CD"):
    return {
        "indicator": {"id": code, "value": "Label"}, "country": {"id": "X", "value": f"Land {id_}"},
        "countryiso3code": id_, "date": "2010", "value": value,
    }


def save(root, dataset, *pages):
    folder = root / f"dataset={dataset}"
    folder.mkdir(parents=True, exist_ok=True)
    for i, page in enumerate(pages, 1):
        # saved answers may be spread over lines
        (folder / f"page{i}.json").write_text(page if isinstance(page, str) else json.dumps(page, indent=1))


def page(number, of, *records):
    return [{"page": number, "pages": of, "per_page": "400", "total": 2}, list(records)]


@pytest.fixture
def pulled(spark, tmp_path):
    root = tmp_path / "pages"
    save(root, "countries", page(1, 2, country("FRA"), country("WLD", "NA", capitalCity="")), page(2, 2, country("ESP", region="ECS", lendingType=None)))
    save(root, "gdp", page(1, 1, figure("FRA", 12.5), figure("", 3), figure("ESP", None)))
    save(root, "population", page(1, 1, figure("FRA", 4, "SP.POP.TOTL")))
    return R.read_pages(spark, str(root))


def test_flatten_countries(pulled):
    rows = dicts(R.flatten_countries(pulled, F.lit(AT)), "country_id")
    assert [r["country_id"] for r in rows] == ["ESP", "FRA", "WLD"]
    assert list(rows[0]) == [
        "country_id", "iso2_code", "country_name", "region_id", "region_name", "admin_region_id", "income_level_id",
        "income_level_name", "lending_type_id", "capital_city", "longitude", "latitude", "source_system", "ingested_at",
    ]
    assert rows[0]["lending_type_id"] is None and rows[1]["lending_type_id"] == "LNX"
    # empty text becomes NULL for capital and coordinates only
    assert rows[2]["capital_city"] is None and rows[1]["latitude"] is None and rows[1]["admin_region_id"] == ""


def test_flatten_indicators(pulled):
    rows = R.flatten_indicators(pulled, F.lit(AT)).collect()
    assert sorted((str(r.country_id), r.indicator_id, r.value) for r in rows if r.value is not None) == [
        ("FRA", "NY.GDP.MKTP.CD", 12.5),
        ("FRA", "SP.POP.TOTL", 4.0),
        ("None", "NY.GDP.MKTP.CD", 3.0),
    ]
    assert [r.country_id for r in rows if r.value is None] == ["ESP"]


def test_complete_pull_passes(pulled):
    R.require_complete(pulled)
    assert {r.dataset: (r.pages_expected, r.pages_seen) for r in R.page_check(pulled).collect()} == {
        "countries": (2, 2),
        "gdp": (1, 1),
        "population": (1, 1),
    }


@pytest.mark.parametrize(
    "bad",
    [
        page(1, 2, figure("FRA", 1)),  # a page is missing
        [{"message": [{"id": "120", "value": "Invalid value"}]}],  # an error answer
        [{"page": 1, "pages": 1}, None],  # no records
        {"page": 1},  # not a list
        "<html>busy</html>",  # not JSON
    ],
)
def test_incomplete_or_malformed_pull_is_refused(spark, tmp_path, bad):
    save(tmp_path, "countries", page(1, 1, country("FRA")))
    save(tmp_path, "gdp", bad)
    with pytest.raises(R.ReferenceDataError, match="gdp"):
        R.require_complete(R.read_pages(spark, str(tmp_path)))


def test_land_and_load_replace(spark, pulled, tmp_path):
    landed, table = str(tmp_path / "landed"), str(tmp_path / "raw")
    countries, figures = R.flatten_countries(pulled, F.lit(AT)), R.flatten_indicators(pulled, F.lit(AT))
    for _ in range(2):
        audit = R.land_reference(countries, figures, landed)
        R.load_countries(spark, landed, f"{table}/c", AT)
        R.load_indicators(spark, landed, f"{table}/i", AT)
    R.require_balanced(audit)
    assert {r.dataset: (r.fetched, r.written, r.aggregates_included, r.null_values) for r in audit.collect()} == {
        "countries": (3, 3, 1, None),
        "gdp": (3, 3, None, 1),
        "population": (1, 1, None, 0),
    }
    raw_countries, raw_figures = spark.read.parquet(f"{table}/c"), spark.read.parquet(f"{table}/i")
    assert (raw_countries.count(), raw_figures.count()) == (3, 4)
    assert raw_countries.first().loaded_at == AT and "countries" in raw_countries.first().source_file
    assert R.country_counts(raw_countries).first().asDict() == {"total_rows": 3, "aggregates": 1, "actual_countries": 2}
    assert dicts(R.indicator_nulls(raw_figures))[0] == {
        "indicator_id": "NY.GDP.MKTP.CD", "year": "2010", "row_count": 3, "non_null_values": 2, "null_values": 1,
    }


def test_lost_rows_are_noticed(spark):
    audit = spark.createDataFrame([("gdp", 3, 2, False)], "dataset string, fetched int, written int, balanced boolean")
    with pytest.raises(R.ReferenceDataError, match="gdp: fetched 3 != written 2"):
        R.require_balanced(audit)


def test_bad_landed_line_stops_the_load(spark, tmp_path):
    (tmp_path / "countries").mkdir()
    (tmp_path / "countries" / "c.json").write_text('{"country_id":"FRA"}\n{bad\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        R.load_countries(spark, str(tmp_path), str(tmp_path / "t"))


def test_mapping_seed_roundtrip(spark, tmp_path):
    R.write_default_mapping(spark, str(tmp_path / "seed"))
    rows = R.read_country_mapping(spark, str(tmp_path / "seed")).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(COUNTRY_MAPPING, key=str)
    kinds = [r.mapping_type for r in rows]
    assert (len(rows), kinds.count("exact"), kinds.count("alias"), kinds.count("assumed"), kinds.count("unmappable")) == (
        43, 34, 5, 1, 3,
    )
    assert all((r.worldbank_country_id is None) == (r.mapping_type == "unmappable") for r in rows)


def test_repeated_page_is_refused(spark, tmp_path):
    save(tmp_path, "gdp", page(1, 1, figure("FRA", 1)), page(1, 1, figure("FRA", 1)))
    with pytest.raises(R.ReferenceDataError, match="gdp"):
        R.require_complete(R.read_pages(spark, str(tmp_path)))


def test_every_landed_dataset_is_loaded(spark, tmp_path):
    save(tmp_path / "pages", "countries", page(1, 1, country("FRA")))
    for dataset, code in (("gdp", "NY.GDP.MKTP.CD"), ("population", "SP.POP.TOTL"), ("area", "AG.LND.TOTL.K2")):
        save(tmp_path / "pages", dataset, page(1, 1, figure("FRA", 4, code)))
    pages, landed, now = R.read_pages(spark, str(tmp_path / "pages")), str(tmp_path / "landed"), F.current_timestamp()
    R.land_reference(R.flatten_countries(pages, now), R.flatten_indicators(pages, now), landed)
    R.load_indicators(spark, landed, str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 3
