import json
from pathlib import Path

import pytest
from conftest import dicts, landed, write_day

from linetally.plans.convert import ConversionError, backfill, convert_month, convert_months, period_range
from linetally.plans.staging import read_audit_files


@pytest.fixture
def job(spark, tmp_path):
    paths = [str(tmp_path / d) for d in ("landing", "staged", "audit")]

    def run(*periods, **options):
        return convert_months(spark, *paths, periods, quarantine=str(tmp_path / "aside"), **options)

    run.landing, run.staged, run.audit = paths
    return run


def staged(spark, job):
    return spark.read.parquet(job.staged)


def february(**changes):
    return landed(invoice_date="2011-02-03T09:00:00", **changes)


def test_balanced_month(spark, job):
    write_day(job.landing, "2011-01-04", landed(), landed(), "{bad")
    write_day(job.landing, "2011-01-05", landed(invoice_date="2011-01-05T10:00:00"), landed(invoice_date=None))
    row = job("2011-01", run_id="r1").first()
    assert (row.source_lines, row.corrupt_rows, row.undated_rows) == (5, 1, 1)
    assert (row.expected_rows, row.rows_written_back, row.difference, row.balanced) == (3, 3, 0, True)
    assert row.status == "converted" and row.output_bytes > 0 and row.job_run_seconds > 0
    assert row.quality.rows_total == 4 and row.quality.unparseable_date == 1
    assert row.output_partition.endswith("/year=2011/month=1")
    # one small month is one file
    assert len(list(Path(job.staged, "year=2011", "month=1").glob("part-*.snappy.parquet"))) == 1


def test_audit_record_is_one_readable_file_per_run(spark, job):
    write_day(job.landing, "2011-01-04", landed())
    job("2011-01", run_id="r1")
    job("2011-01", run_id="r1")
    job("2011-01", run_id="r2")
    files = sorted(Path(job.audit).glob("job=*/period=2011-01/run=*/part-*"))
    assert [f.parent.name for f in files] == ["run=r1", "run=r2"]
    record = json.loads(files[0].read_text())
    assert record["source_lines"] == 1 and record["balanced"] is True and record["quality"]["rows_total"] == 1
    assert read_audit_files(spark, job.audit).count() == 2


def test_rerun_replaces_only_its_month(spark, job):
    write_day(job.landing, "2011-01-04", landed(), landed())
    write_day(job.landing, "2011-02-03", february())
    job("2011-01", "2011-02")
    write_day(job.landing, "2011-01-04", landed(quantity=1))
    job("2011-01")
    assert dicts(staged(spark, job).groupBy("year", "month").count(), "month") == [
        {"year": 2011, "month": 1, "count": 1},
        {"year": 2011, "month": 2, "count": 1},
    ]


def test_blank_line_is_an_imbalance(spark, job):
    write_day(job.landing, "2011-01-04", landed(), "")
    with pytest.raises(ConversionError, match="2011-01: unbalanced"):
        job("2011-01")
    # the audit record of the failed run is there all the same
    assert '"balanced" : false' in next(Path(job.audit).rglob("part-*")).read_text()


def test_imbalance_can_be_a_warning(spark, job):
    write_day(job.landing, "2011-01-04", landed(), "")
    row = job("2011-01", fail_on_mismatch=False).first()
    assert (row.balanced, row.difference, row.status) == (False, -1, "unbalanced")


def test_stray_month_is_refused_before_writing(spark, job):
    write_day(job.landing, "2011-02-03", february(), february())
    job("2011-02")
    write_day(job.landing, "2011-01-04", landed(), february())
    with pytest.raises(ConversionError, match="2011-01: stray_rows") as stopped:
        job("2011-01", fail_on_mismatch=False)
    assert stopped.value.recon.first().stray_rows == 1
    # February was not overwritten by the stray line, January was not written
    assert dicts(staged(spark, job).groupBy("month").count()) == [{"month": 2, "count": 2}]


def test_month_without_lines_fails(spark, job):
    write_day(job.landing, "2011-01-04", landed())
    with pytest.raises(ConversionError, match="1999-01: no_source_lines"):
        job("1999-01")


def test_all_lines_bad(spark, job):
    write_day(job.landing, "2011-01-04", "{bad", landed(invoice_date="never"))
    row = job("2011-01").first()
    assert (row.source_lines, row.expected_rows, row.rows_written_back, row.status) == (2, 0, 0, "converted")


def test_backfill_goes_on_after_a_failed_month(spark, job):
    write_day(job.landing, "2011-01-04", landed())
    write_day(job.landing, "2011-03-04", landed(invoice_date="2011-03-04T10:00:00"))
    with pytest.raises(ConversionError, match="^2011-02: no_source_lines") as stopped:
        backfill(spark, job.landing, job.staged, job.audit, "2011-01", "2011-03")
    assert [(r.period, r.status) for r in stopped.value.recon.orderBy("period").collect()] == [
        ("2011-01", "converted"),
        ("2011-02", "no_source_lines"),
        ("2011-03", "converted"),
    ]
    assert staged(spark, job).count() == 2


def test_convert_month_is_one_period(spark, job):
    write_day(job.landing, "2011-01-04", landed())
    assert convert_month(spark, job.landing, job.staged, job.audit, "2011-01").count() == 1


def test_quarantine_holds_what_was_not_written(spark, job, tmp_path):
    write_day(job.landing, "2011-01-04", landed(), "{bad", landed(invoice_date="soon"))
    row = job("2011-01").first()
    aside = spark.read.schema("reason string, line string, period string").json(str(tmp_path / "aside"))
    assert row.source_lines == row.rows_written_back + aside.count()
    assert {(r.period, r.reason) for r in aside.collect()} == {("2011-01", "corrupt"), ("2011-01", "undated")}


def test_period_range():
    assert period_range("2010-11", "2011-02") == ["2010-11", "2010-12", "2011-01", "2011-02"]
    assert period_range("2011-08", "2011-08") == ["2011-08"]
    with pytest.raises(ValueError, match="before"):
        period_range("2011-02", "2011-01")


def test_rerun_without_good_rows_leaves_no_stale_partition(spark, job):
    """A period converted again whose lines are all undated or corrupt holds nothing afterwards, and converts."""
    write_day(job.landing, "2011-01-04", landed())
    write_day(job.landing, "2011-02-03", february())
    job("2011-01", "2011-02")
    write_day(job.landing, "2011-01-04", landed(invoice_date="no date"), "{cut")
    row = job("2011-01").first()
    assert (row["status"], row["rows_written_back"], row["undated_rows"], row["corrupt_rows"]) == ("converted", 0, 1, 1)
    assert not Path(job.staged, "year=2011", "month=1").exists() and staged(spark, job).count() == 1


def test_content_read_back_is_compared(spark, job, monkeypatch):
    """Rows that were exchanged on the way to the files stop the conversion, though the counts agree."""
    from linetally.plans import convert

    write = convert.write_periods

    def write_other(rows, path, *args, **more):
        if path == job.staged:
            rows = rows.replace("85123A", "85123B", "stock_code")
        write(rows, path, *args, **more)

    monkeypatch.setattr(convert, "write_periods", write_other)
    write_day(job.landing, "2011-01-04", landed(), landed(quantity=2))
    with pytest.raises(ConversionError, match="2011-01: content_differs"):
        job("2011-01")
