from datetime import datetime

from pyspark.sql import functions as F

from linetally.functions import columns as K


def one(spark, ddl, row, *cols):
    return spark.createDataFrame([row], ddl).select(*cols).first()


def test_period_key_pads_and_keeps_null(spark):
    df = spark.createDataFrame([(2011, 1), (2010, 12), (None, 3), (2011, None)], "y int, m int")
    assert [r[0] for r in df.select(K.period_key("y", "m")).collect()] == ["2011-01", "2010-12", None, None]


def test_line_type_first_match_wins(spark):
    rows = [
        ("C1", -1, 0.0, "cancellation"),
        ("C2", 5, 2.0, "cancellation"),
        ("3", -1, 0.0, "negative_adjustment"),
        ("4", 1, 0.0, "zero_or_negative_price"),
        ("5", 1, -1.0, "zero_or_negative_price"),
        ("6", 1, 1.0, "normal"),
        (None, 1, 1.0, "normal"),
        ("c7", 1, 1.0, "normal"),
        ("8", None, None, "normal"),
    ]
    df = spark.createDataFrame(rows, "i string, q int, p double, want string")
    got = df.select(K.line_type("i", "q", "p").alias("t"), "want").collect()
    assert [r.t for r in got] == [r.want for r in got]


def test_cancellation_of_null_invoice_is_false(spark):
    df = spark.createDataFrame([("C1",), (None,), ("1C",), ("",)], "i string")
    assert [r[0] for r in df.select(K.is_cancellation("i")).collect()] == [True, False, False, False]


def test_whole_number_text(spark):
    df = spark.createDataFrame([("17850.0",), ("17850",), (None,), ("x",)], "c string")
    assert [r[0] for r in df.select(K.whole_number_text("c")).collect()] == ["17850", "17850", None, None]


def test_unreadable_times_become_null(spark):
    df = spark.createDataFrame([("2011-01-04T10:00:00",), ("2011-01-04",), ("no",), (None,)], "t string")
    got = [r[0] for r in df.select(K.wall_clock("t")).collect()]
    assert got == [datetime(2011, 1, 4, 10), datetime(2011, 1, 4), None, None]


def test_ratio_over_zero_or_null_is_null(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (1, None), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(K.ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None, None, None]


def test_mask_hides_and_groups(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    dev = [r[0] for r in df.select(K.masked("c", "dev")).collect()]
    prod = [r[0] for r in df.select(K.masked("c", "prod")).collect()]
    assert dev[0] == dev[1] != dev[2] and dev[3] is None and len(dev[0]) == 64
    assert not set(dev[:3]) & set(prod[:3])


def test_path_number(spark):
    df = spark.createDataFrame([("s/year=2011/month=1/part-0",), ("s/part-0",)], "p string")
    assert [tuple(r) for r in df.select(K.path_number("p", "year"), K.path_number("p", "month")).collect()] == [
        (2011, 1),
        (None, None),
    ]


def test_money_sum_does_not_depend_on_order(spark):
    values = [0.1, 1e9, -1e9, 0.2, 0.3] * 50
    sums = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        sums.add(df.agg(K.money_out(F.sum(K.money("v")))).first()[0])
    assert sums == {30.0}


def test_totals_beyond_a_bigint(spark):
    df = spark.createDataFrame([(i % 2, 9_000_000_000_000_000_000 * (1 if i % 3 else -1)) for i in range(30)], "k int, v long")
    want = sum(9_000_000_000_000_000_000 * (1 if i % 3 else -1) for i in range(30))
    assert int(df.agg(K.total_units(F.col("v")).alias("t")).first().t) == want
    folded = df.groupBy("k").agg(*K.unit_sums(F.col("v"), "x"))
    assert int(folded.agg(K.folded_units("x").alias("t")).first().t) == want
