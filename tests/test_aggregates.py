from linetally.operators.aggregates import exact_copies, latest_by, most_frequent


def test_most_frequent_ties_and_nulls(spark):
    rows = [
        *[("a", "x")] * 2, *[("a", "y")] * 2,  # tie: smallest
        *[("b", None)] * 3, ("b", "z"),  # NULL competes
        *[("c", None)] * 2, *[("c", "q")] * 2,  # NULL loses a tie
        ("d", None),
        (None, "n"),
    ]
    got = {r.k: r.v for r in most_frequent(spark.createDataFrame(rows, "k string, v string"), "k", "v").collect()}
    assert got == {"a": "x", "b": None, "c": "q", "d": None, None: "n"}


def test_latest_by_takes_whole_rows(spark):
    rows = [("p", 1, "r1", 10), ("p", 2, "r2", None), ("p", 2, "r3", 30), ("q", None, "r4", 1)]
    df = spark.createDataFrame(rows, "period string, at int, run string, n int")
    got = sorted(map(tuple, latest_by(df, "period", ("at", "run")).collect()))
    assert got == [("p", 2, "r3", 30), ("q", None, "r4", 1)]


def test_exact_copies(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "x string, y int")
    assert sorted(map(str, exact_copies(df, ["x", "y"]).collect())) == [
        "Row(x='a', y=None, copies=2)",
        "Row(x='b', y=1, copies=1)",
    ]
