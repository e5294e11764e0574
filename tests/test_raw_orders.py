from datetime import datetime
from pathlib import Path

import pytest
from conftest import dicts, raw_row

from linetally.operators.checks import loaded_twice, several_files_per_period
from linetally.schemas import RAW_ORDER
from linetally.sources import raw_orders as RAW
from pyspark.sql import functions as F

AT1, AT2 = datetime(2011, 3, 1), datetime(2011, 3, 2)


@pytest.fixture
def stage(spark, tmp_path):
    """Write one staged file per call."""

    def write(year, month, *quantities):
        rows = [raw_row(quantity=q, invoice_date=datetime(year, month, 5)) for q in quantities]
        body = spark.createDataFrame(rows, RAW_ORDER).drop("source_file", "loaded_at", "partition_year", "partition_month")
        body.coalesce(1).write.mode("append").parquet(str(tmp_path / "staged" / f"year={year}" / f"month={month}"))

    write.staged, write.raw = str(tmp_path / "staged"), str(tmp_path / "raw")
    return write


def test_keys_come_from_the_path_and_lineage_is_kept(spark, stage):
    stage(2011, 1, 1, 2)
    RAW.load_periods(spark, stage.staged, stage.raw, ["2011-01"], AT1)
    rows = RAW.read_raw(spark, stage.raw).collect()
    assert {(r.partition_year, r.partition_month, r.loaded_at) for r in rows} == {(2011, 1, AT1)}
    assert all("year=2011/month=1/part-" in r.source_file for r in rows)
    assert rows[0].__fields__ == RAW_ORDER.fieldNames()


def test_path_without_keys_gives_null_keys(spark, stage, tmp_path):
    stage(2011, 1, 1)
    (tmp_path / "loose").mkdir()
    for f in Path(stage.staged).rglob("part-*.parquet"):
        (tmp_path / "loose" / f.name).write_bytes(f.read_bytes())
    rows = RAW.read_staged_files(spark, str(tmp_path / "loose"))
    assert rows.count() == 1
    assert RAW.null_partition_keys(rows).first()[0] == 1


def test_marker_objects_are_skipped_and_bad_files_stop_the_load(spark, stage):
    stage(2011, 1, 1)
    folder = Path(stage.staged, "year=2011", "month=1")
    (folder / "month=1_$folder$").write_text("")
    RAW.load_periods(spark, stage.staged, stage.raw, ["2011-01"], AT1)
    assert RAW.read_raw(spark, stage.raw).count() == 1
    (folder / "part-9.snappy.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)part-9|parquet"):
        RAW.load_periods(spark, stage.staged, stage.raw, ["2011-01"], AT1)


def test_loaded_files_are_skipped(spark, stage):
    stage(2011, 1, 1)
    assert RAW.load_new_files(spark, stage.staged, stage.raw, AT1) == 1
    assert RAW.load_new_files(spark, stage.staged, stage.raw, AT2) == 0
    stage(2011, 1, 2, 3)
    stage(2011, 2, 4)
    assert RAW.files_to_load(spark, stage.staged, stage.raw).count() == 2
    assert RAW.load_new_files(spark, stage.staged, stage.raw, AT2) == 2
    raw = RAW.read_raw(spark, stage.raw)
    assert sorted(r.quantity for r in raw.collect()) == [1, 2, 3, 4]
    assert {(r.period, r.distinct_files) for r in several_files_per_period(raw).collect()} == {("2011-01", 2)}


def test_reload_replaces_the_period(spark, stage, tmp_path):
    stage(2011, 1, 1, 2)
    stage(2011, 2, 7)
    for _ in range(2):  # a rerun does not double anything
        RAW.load_periods(spark, stage.staged, stage.raw, ["2011-01", "2011-02"], AT1)
    assert RAW.read_raw(spark, stage.raw).count() == 3
    RAW.load_periods(spark, str(tmp_path / "nothing"), stage.raw, ["2011-01"], AT2)
    assert dicts(RAW.partition_summary(RAW.read_raw(spark, stage.raw)).select("partition_month", "row_count")) == [
        {"partition_month": 2, "row_count": 1}
    ]


def test_period_predicate_prunes(spark, stage):
    stage(2011, 1, 1)
    stage(2011, 2, 2)
    RAW.load_periods(spark, stage.staged, stage.raw, ["2011-01", "2011-02"], AT1)
    raw = RAW.read_raw(spark, stage.raw).where(RAW.in_periods(["2011-02"]))
    scan = raw._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "partition_month" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert [r.quantity for r in raw.collect()] == [2]


def test_double_load_is_seen(spark, raw_frame):
    raw = raw_frame({"source_file": "a"}, {"source_file": "a"}, {"source_file": "b"})
    own = raw.groupBy("source_file").agg(F.lit(1).cast("bigint").alias("rows_in_file"))
    assert [r.source_file for r in loaded_twice(raw, own).collect()] == ["a"]
    # two loads of one file are not two files
    assert several_files_per_period(raw.where("source_file = 'a'")).count() == 0
