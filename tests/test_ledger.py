"""Ledgers: entries follow the tables, increments read them and not the tables, fingerprints see exchanged rows."""

import pytest
from pyspark.sql import functions as F

from linetally.plans import recon as N
from linetally.plans import staging as S
from linetally.sources import ledger
from linetally.sources import raw_orders as RAW
from linetally.sources.files import write_periods


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "raw"), str(tmp_path / "stream"), str(tmp_path / "stg")


def lines(raw_frame, month, *quantities):
    return raw_frame(*[{"partition_month": month, "quantity": q, "stock_code": f"s{k}"} for k, q in enumerate(quantities)])


def put(spark, rows, raw):
    """A load as the library makes it: struck out, written, measured when asked for."""
    ledger.strike(spark, raw, [f"{r[0]}-{r[1]:02d}" for r in rows.select("partition_year", "partition_month").distinct().collect()])
    write_periods(rows, raw, RAW.PARTITION)


def test_increment_reads_ledgers_only(spark, raw_frame, paths, monkeypatch):
    raw, stream, stg = paths
    put(spark, lines(raw_frame, 1, 1, 2), raw)
    put(spark, lines(raw_frame, 2, 3), raw)
    assert S.refresh_from_ledgers(spark, raw, stream, stg) == ["2011-01", "2011-02"]
    put(spark, lines(raw_frame, 2, 4, 5, 6), raw)
    RAW.raw_entries(spark, raw)
    differ = S.differing_periods(RAW.all_entries(spark, raw, stream), S.stg_entries(spark, stg))
    assert all("/_ledger/" in f for f in differ.inputFiles())  # neither RAW nor staging is scanned
    assert [r[0] for r in differ.collect()] == ["2011-02"]
    assert S.refresh_from_ledgers(spark, raw, stream, stg) == ["2011-02"]
    assert S.refresh_from_ledgers(spark, raw, stream, stg) == []
    assert S.read_stg(spark, stg).count() == 5


def test_only_periods_without_an_entry_are_measured(spark, raw_frame, paths):
    raw, _, _ = paths
    put(spark, lines(raw_frame, 1, 1), raw)
    RAW.raw_entries(spark, raw)
    asked = []

    def read(periods):
        asked.extend(periods)
        return RAW.read_raw(spark, raw).where(RAW.in_periods(periods))

    put(spark, lines(raw_frame, 2, 1, 1), raw)
    assert {(r["period"], r["n"]) for r in ledger.brought_up(spark, raw, read).collect()} == {("2011-01", 1), ("2011-02", 2)}
    assert asked == ["2011-02"]


def test_same_count_other_content_is_rebuilt(spark, raw_frame, paths):
    """Equal rows and load time, one value exchanged: counts and newest load do not show it."""
    raw, stream, stg = paths
    put(spark, lines(raw_frame, 1, 1, 2, 3), raw)
    S.refresh_from_ledgers(spark, raw, stream, stg)
    put(spark, lines(raw_frame, 1, 1, 2, 4), raw)
    assert S.refresh_from_ledgers(spark, raw, stream, stg) == ["2011-01"]
    assert sorted(r[0] for r in S.read_stg(spark, stg).select("quantity").collect()) == [1, 2, 4]


def test_period_gone_from_raw(spark, raw_frame, paths):
    raw, stream, stg = paths
    put(spark, lines(raw_frame, 1, 1), raw)
    put(spark, lines(raw_frame, 2, 1), raw)
    S.refresh_from_ledgers(spark, raw, stream, stg)
    RAW.load_periods(spark, str(stg) + "-nothing-staged", raw, ["2011-01"])
    assert S.refresh_from_ledgers(spark, raw, stream, stg) == ["2011-01"]
    assert {r[0] for r in S.read_stg(spark, stg).select("period").distinct().collect()} == {"2011-02"}


def test_fingerprints_count_copies_and_add_up(spark, raw_frame):
    one, two = lines(raw_frame, 1, 1, 2, 2), lines(raw_frame, 1, 3)
    sums = ledger.RAW_SUMS + ledger.CLEAN_SUMS
    whole = ledger.measured(one.unionByName(two)).select(*sums).first()
    parts = ledger.added_up(ledger.measured(one), ledger.measured(two)).select(*sums).first()
    assert whole == parts
    assert ledger.measured(one).select(*sums).first() == ledger.measured(one.repartition(3)).select(*sums).first()
    twice = ledger.measured(one.unionByName(one)).select(*sums).first()
    assert twice != ledger.measured(one).select(*sums).first() and all(v > 0 for v in twice)
    nulls = raw_frame({"description": None, "customer_id": "x"}), raw_frame({"description": "x", "customer_id": None})
    assert len({tuple(ledger.measured(n).select(*sums).first()) for n in nulls}) == 2


@pytest.mark.parametrize(("hop", "status"), [(None, "ok"), ("staged", "lines_to_staged_differ"), ("raw", "staged_to_raw_differ"), ("stg", "raw_to_staging_differ")])
def test_altered_row_with_equal_counts(spark, raw_frame, hop, status):
    rows = {"staged": lines(raw_frame, 1, 1, 2, 2)}
    rows |= {"raw": rows["staged"], "stg": S.stg_orders(rows["staged"])}
    if hop:
        changed = F.when(F.col("stock_code") == "s1", F.col("quantity") + 7).otherwise(F.col("quantity"))
        for later in list(rows)[list(rows).index(hop) :]:
            rows[later] = rows[later].withColumn("quantity", changed)
    period = F.lit("2011-01")
    found = N.content_reconciliation(
        ledger.measured_lines(lines(raw_frame, 1, 1, 2, 2), period), ledger.measured_lines(rows["staged"], period),
        ledger.measured(rows["raw"]), ledger.measured(rows["stg"]),
    )
    assert [tuple(r) for r in found.collect()] == [("2011-01", 3, 3, 3, 3, status)]
    if hop:
        with pytest.raises(N.ReconciliationError, match=status):
            N.require_same_content(found, ["2011-01"])
