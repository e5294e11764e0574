"""Contents of two environments: planted rows are found, only branches that differ are read on, equal tables give nothing."""

import re

import pytest
from pyspark.sql import functions as F

from linetally.functions.columns import ORDER_COLUMNS, period_key
from linetally.operators.diff import content_diff
from linetally.sources import raw_orders as RAW
from linetally.sources.files import write_periods

@pytest.fixture(scope="module")
def raw(spark, raw_frame, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("diff") / "raw")
    rows = [{"partition_month": 1 + k % 3, "quantity": k, "stock_code": f"s{k % 7}", "customer_id": None if k % 5 else "7"} for k in range(300)]
    write_periods(raw_frame(*rows, *rows[:9]), path, RAW.PARTITION)
    return RAW.read_raw(spark, path)


def diff(left, right, **options):
    return content_diff(left, right, period_key("partition_year", "partition_month"), ORDER_COLUMNS, ("dev", "prod"), **options)


def brief(df):
    return sorted((r.period, r.quantity, r.only_in, r.copies) for r in df.collect())


def test_equal_tables_in_any_order_and_layout(raw):
    assert brief(diff(raw, raw.repartition(7, "quantity").orderBy(F.desc("quantity")))) == []


@pytest.mark.parametrize("rows_per_branch", [1, 10, 100_000])
def test_one_planted_row(raw, rows_per_branch):
    changed = raw.withColumn("quantity", F.when(F.col("quantity") == 100, -1).otherwise(F.col("quantity")))
    assert brief(diff(raw, changed, rows_per_branch=rows_per_branch)) == [("2011-02", -1, "prod", 1), ("2011-02", 100, "dev", 1)]


def test_copies_are_counted_and_null_is_a_value(raw):
    once = raw.dropDuplicates(list(ORDER_COLUMNS))
    found = brief(diff(raw, once, rows_per_branch=10))
    assert len(found) == 9 and {(r[2], r[3]) for r in found} == {("dev", 1)}
    named = raw.withColumn("customer_id", F.when(F.col("quantity") == 3, "").otherwise(F.col("customer_id")))
    assert brief(diff(raw, named)) == [("2011-01", 3, "dev", 2), ("2011-01", 3, "prod", 2)]


def test_missing_periods_and_empty_tables(raw):
    less = raw.where("partition_month <> 3")
    assert {(r[0], r[2]) for r in brief(diff(raw, less))} == {("2011-03", "dev")}
    assert sum(r[3] for r in brief(diff(raw.limit(0), raw))) == 309
    assert brief(diff(raw.limit(0), raw.limit(0))) == []


def test_rows_without_a_period(raw):
    lost = raw.withColumn("partition_month", F.when(F.col("quantity") != 5, F.col("partition_month")))
    found = brief(diff(raw, lost).withColumn("period", F.coalesce("period", F.lit("none"))))
    assert found == [("2011-03", 5, "dev", 2), ("none", 5, "prod", 2)]


def test_only_differing_periods_and_branches_are_read(raw):
    changed = raw.withColumn("quantity", F.when(F.col("quantity") == 100, -1).otherwise(F.col("quantity")))
    out = diff(raw, changed, rows_per_branch=10)
    plan = out._jdf.queryExecution()
    assert plan.executedPlan().toString().count("PartitionFilters: [(concat(lpad(cast(partition_year") == 2
    found = re.findall(r"2011-\d\d", plan.optimizedPlan().toString())
    assert found and set(found) == {"2011-02"}
    assert [f for f in out.inputFiles() if "/branches-" in f]  # the last step joins the differing branches
