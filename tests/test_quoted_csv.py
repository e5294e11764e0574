"""Quoted CSV read by ranges, against one task that reads the whole file."""

import random

import pytest

from linetally.sources.quoted_csv import records

COLUMNS = [f"c{i}" for i in range(4)]


def field(rng):
    kind = rng.randrange(8)
    word = "".join(rng.choice("abc é") for _ in range(rng.randrange(1, 9))).strip() or "x"
    if kind < 3:
        return word
    if kind == 3:
        return f'5{word}" pipe'  # a quote that opens nothing
    inner = word + rng.choice(["", "\n", "\r\n", ",", '""', "\n\n", '",\n""'.replace('",', '"",'), "," * 3]) + word
    return f'"{inner}"'


def write(path, rng, rows, newline="\n"):
    text = ",".join(COLUMNS) + newline + "".join(",".join(field(rng) for _ in COLUMNS) + newline for _ in range(rows))
    path.write_bytes(text.encode("latin-1"))


def by_ranges(spark, path, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = records(spark, str(path), "ISO-8859-1")
        tasks = spark.read.text(str(path)).rdd.getNumPartitions()
        return sorted((r["record"], r["whole"]) for r in found.collect()), tasks
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def whole_file(spark, path):
    reader = spark.read.options(header="true", escape='"', multiLine="true", encoding="ISO-8859-1", lineSep="\n")
    schema = ", ".join(f"{c} string" for c in COLUMNS)
    return sorted(map(repr, reader.schema(schema).csv(str(path)).collect()))


def parsed(spark, rows):
    from pyspark.sql import functions as F

    schema = ", ".join(f"{c} string" for c in COLUMNS)
    df = spark.createDataFrame([(r,) for r, _ in rows], "record string").select(F.from_csv("record", schema, {"escape": '"'}).alias("f")).select("f.*")
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("size", [64, 700])
def test_same_as_one_task(spark, tmp_path, size):
    """Many ranges, some inside one quoted field, some without any beginning of a record."""
    rng = random.Random(size)
    for k in range(2):
        write(tmp_path / f"{k}.csv", rng, 150)
    got, tasks = by_ranges(spark, tmp_path, size)
    assert tasks > 10 and all(w for _, w in got)
    assert parsed(spark, got) == whole_file(spark, tmp_path)


def test_quote_over_many_ranges(spark, tmp_path):
    long = "line\n" * 400
    (tmp_path / "a.csv").write_text(f'h1,h2\r\n1,"{long}"\r\n2,x\r\n\r\n3,"y""\r\nz"\r\n')
    got, tasks = by_ranges(spark, tmp_path, 128)
    assert tasks > 10 and got == sorted([(f'1,"{long}"', True), ("2,x", True), ('3,"y""\r\nz"', True)])


def test_unclosed_quote_is_not_one_record(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h1,h2\n1,a\n" + '2,"never closed\n' + "3,b\n" * 50)
    got, _ = by_ranges(spark, tmp_path, 64)
    assert got == sorted([("1,a", True), ('2,"never closed', False), *[("3,b", False)] * 50])


def test_header_only_and_empty(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"h\n1",h2\n')
    (tmp_path / "b.csv").write_text("")
    assert by_ranges(spark, tmp_path, 64)[0] == []


def test_lines_are_not_shuffled_to_learn_their_ranges(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n1,"x\ny"\n2,z\n', encoding="utf-8")
    plan = records(spark, str(tmp_path / "f.csv"), "UTF-8")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert joins and all("strategy=broadcast" in line for line in joins)


def test_never_closed_over_ranges(spark, tmp_path):
    """Files of random quotes, cut short anywhere, and headers of several lines: the same by ranges as in one."""
    rng = random.Random(5)
    for k in range(12):
        text = "".join(rng.choice(['"', '""', ",", "a", "\n", "\n", '\n"', '",\n']) for _ in range(400))
        (tmp_path / f"{k}.csv").write_text(('"h\n1",h2' if k % 3 else '"h,h2') + ("\n" if k % 2 else "") + text)
    got, tasks = by_ranges(spark, tmp_path, 48)
    whole, _ = by_ranges(spark, tmp_path, 1 << 20)
    assert tasks > 50 and {w for _, w in got} == {True, False} and got == whole


def test_lines_without_quotes_are_not_shuffled(spark, tmp_path):
    """Nor are quotes a reason that close on their line."""
    (tmp_path / "f.csv").write_text('a,b\n1,"x,y"\n2,5" pipe\n\n3,z\r\n')
    found = records(spark, str(tmp_path / "f.csv"), "UTF-8")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    assert sorted(r["record"] for r in found.collect()) == ['1,"x,y"', '2,5" pipe', "3,z"]


def test_lines_are_shuffled_once(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = records(spark, str(tmp_path / "f.csv"), "UTF-8")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert plan.count("Exchange hashpartitioning") == 1


def test_other_ranges_are_refused(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b\n" + "1,x\n" * 100)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = records(spark, str(tmp_path / "f.csv"), "UTF-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        with pytest.raises(Exception, match="other ranges"):
            found.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
