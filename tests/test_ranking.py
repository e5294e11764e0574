import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from linetally.env import written
from linetally.operators.ranking import ntile_by_selection, ntile_over_all, number_within, ranged_row_number, tile_of


def keyed(spark, rows):
    return written(spark.createDataFrame(rows, "k string, a int, b string"), "t")


def order():
    return [F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first()]


def plain(df):
    return df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*order())))


def bag(df):
    return sorted(map(str, df.select("k", "a", "b", "n").collect()))


def skewed_rows():
    rnd = random.Random(7)
    rows = [("hot", 1, "same")] * 400  # exact copies
    rows += [("hot", rnd.randint(0, 50), rnd.choice("xyz")) for _ in range(300)]
    rows += [(None, rnd.randint(0, 9), None) for _ in range(120)]
    rows += [(f"k{rnd.randint(0, 150)}", rnd.randint(0, 5), rnd.choice(["p", None])) for _ in range(400)]
    rnd.shuffle(rows)
    return rows


def test_ranged_row_number_equals_window(spark):
    df = keyed(spark, skewed_rows())
    assert bag(ranged_row_number(df, ["k"], order(), "n", partitions=7)) == bag(plain(df))


def test_ranged_form_splits_a_group_of_copies(spark):
    df = keyed(spark, [("hot", 1, "same")] * 5000)
    out = ranged_row_number(df, ["k"], order(), "n", partitions=8)
    assert sorted(r.n for r in out.collect()) == list(range(1, 5001))
    # the ranged rows really are in several pieces of the key
    tied = df.withColumn("t", F.monotonically_increasing_id()).repartitionByRange(8, "k", "a", "b", "t")
    assert tied.groupBy(F.spark_partition_id()).count().count() > 1


@pytest.mark.parametrize("limit", [50, 350, 10_000])
def test_number_within_is_the_same_on_both_ways(spark, limit):
    df = keyed(spark, skewed_rows())
    assert bag(number_within(df, ["k"], order(), "n", one_task_rows=limit)) == bag(plain(df))


def test_number_within_along_a_derived_column(spark):
    df = keyed(spark, skewed_rows()).withColumn("bucket", F.pmod(F.xxhash64("k"), F.lit(3)))
    for limit in (50, 10_000):
        got = number_within(df, ["k"], order(), "n", limit, ("bucket",), 3)
        assert bag(got) == bag(plain(df))


@pytest.mark.parametrize("tiles", [1, 3, 4])
def test_tile_arithmetic_equals_ntile(spark, tiles):
    for n in (*range(0, 11), 100):
        df = spark.range(n).withColumn("rn", F.col("id") + 1)
        want = df.select(F.ntile(tiles).over(Window.orderBy("rn")).alias("t"), "rn").collect()
        got = df.select(tile_of(F.col("rn"), n, tiles).alias("t"), "rn").collect()
        assert sorted(want, key=lambda r: r.rn) == sorted(got, key=lambda r: r.rn)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 10, 101])
def test_ranged_ntile_with_ties(spark, n):
    rows = [(f"c{i:03d}", float(i // 4) if i % 5 else None) for i in range(n)]
    df = written(spark.createDataFrame(rows, "id string, v double"), "t")
    by = [F.col("v").asc_nulls_last(), F.col("id").asc()]
    one = ntile_over_all(df, 3, by, "tile")
    ranged = ntile_over_all(df, 3, by, "tile", partitions=5)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, ranged.collect()), key=str)


def test_big_ntile_plans_no_single_partition_over_the_rows(spark):
    df = written(spark.range(2000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 7).alias("v")), "t")
    out = ntile_over_all(df, 3, [F.col("v").asc(), F.col("id").asc()], "tile")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the only single-partition step is over the per-partition counts
    assert plan.count("SinglePartition") <= 1 and "ntile" not in plan
    assert out.count() == 2000


AWKWARD = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1e308, -1e308, 5e-324, 0.1, 0.1 + 2**-56]


@pytest.mark.parametrize(("few", "ranges"), [(0, 4), (3, 16), (10_000, 4096)])
@pytest.mark.parametrize("tiles", [2, 3, 5])
def test_selected_tiles_are_those_of_the_window(spark, tiles, few, ranges):
    """Ties, extreme values, NaN, infinity and NULL; every boundary is found by refining where few is 0."""
    rng = random.Random(7 * tiles + few)
    values = AWKWARD + [rng.choice([0.0, 12.5, rng.uniform(-9, 9), rng.uniform(0, 1e6)]) for _ in range(60)]
    rows = [(v, f"{rng.choice(['', 'a', 'é', '日'])}{i}") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "v double, id string")
    window = Window.orderBy(F.col("v").asc_nulls_last(), F.col("id"))
    want = {r["id"]: r["t"] for r in df.withColumn("t", F.ntile(tiles).over(window)).collect()}
    got = {r["id"]: r["t"] for r in ntile_by_selection(df, tiles, "v", "id", "t", ranges, few).collect()}
    assert got == want


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_selected_tiles_of_few_rows(spark, n):
    df = spark.createDataFrame([(1.0, str(i)) for i in range(n)], "v double, id string")
    got = [r["t"] for r in ntile_by_selection(df, 3, "v", "id", "t").orderBy("id").collect()]
    assert got == [[], [1], [1, 2], [], [1, 1, 2, 3]][n]


def test_selected_tiles_shuffle_no_rows(spark, tmp_path):
    spark.range(500).selectExpr("cast(id % 7 as double) v", "cast(id as string) id").write.parquet(str(tmp_path / "t"))
    tiled = ntile_by_selection(spark.read.parquet(str(tmp_path / "t")), 3, "v", "id", "t", few=5)
    plan = tiled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert sorted(r["count"] for r in tiled.groupBy("t").count().collect()) == [166, 167, 167]


def test_tiles_are_selected_by_double_and_text(spark):
    with pytest.raises(TypeError):
        ntile_by_selection(spark.range(3).selectExpr("id v", "'a' id"), 3, "v", "id", "t")
