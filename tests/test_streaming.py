import shutil
from datetime import datetime

from conftest import landed, write_day

from linetally.plans import staging as S
from linetally.sources.files import write_periods
from linetally.sources.raw_orders import PARTITION, read_all_raw, read_raw
from linetally.streaming.replay import read_stream_audit, replay

LATER = datetime(2011, 4, 1)


def setup(spark, raw_frame, tmp_path, *rows):
    paths = {n: str(tmp_path / n) for n in ("raw", "stream_raw", "stg", "checkpoint", "quarantine", "audit")}
    write_periods(raw_frame(*rows), paths["raw"], PARTITION)
    S.build_stg_orders(read_raw(spark, paths["raw"]), paths["stg"])
    return paths


def run(spark, tmp_path, paths, **more):
    replay(
        spark, str(tmp_path / "in"), paths["raw"], paths["stream_raw"], paths["stg"], paths["checkpoint"],
        paths["quarantine"], paths["audit"], loaded_at=LATER, **more,
    )


def staged(spark, paths):
    rows = S.read_stg(spark, paths["stg"]).collect()
    return sorted((r.period, r.invoice_no, r.quantity, r.duplicate_occurrence, r.source_system) for r in rows)


def live(no, when, **more):
    return landed(invoice_no=no, invoice_date=when, source_system="stream_live", **more)


def test_replay_late_and_new_periods(spark, raw_frame, tmp_path):
    paths = setup(spark, raw_frame, tmp_path, {}, {"invoice_no": "9", "invoice_date": datetime(2010, 12, 5)})
    # a late copy of a line of a built period, and a new period over several files
    write_day(tmp_path / "in", "2011-01-04", landed(source_system="stream_live"), "{bad", live("8", "never"))
    write_day(tmp_path / "in", "2011-02-01", live("1", "2011-02-01T09:00:00"))
    write_day(tmp_path / "in", "2011-02-02", live("2", "2011-02-02T09:00:00"))
    run(spark, tmp_path, paths, max_files=1)
    want = [
        ("2010-12", "9", 6, 1, "batch_historical"),
        ("2011-01", "536365", 6, 1, "batch_historical"),
        ("2011-01", "536365", 6, 2, "stream_live"),
        ("2011-02", "1", 6, 1, "stream_live"),
        ("2011-02", "2", 6, 1, "stream_live"),
    ]
    assert staged(spark, paths) == want
    # every line is somewhere: three stored, two set aside
    assert spark.read.parquet(paths["stream_raw"]).count() == 3
    aside = spark.read.parquet(paths["quarantine"])
    assert sorted(r.reason for r in aside.collect()) == ["corrupt", "undated"]

    # nothing new: nothing happens
    run(spark, tmp_path, paths)
    assert staged(spark, paths) == want

    # a file that arrives later goes on from the checkpoint
    write_day(tmp_path / "in", "2011-02-02", live("3", "2011-02-02T10:00:00"), name="late.json")
    run(spark, tmp_path, paths)
    assert staged(spark, paths) == [*want, ("2011-02", "3", 6, 1, "stream_live")]


def test_batch_that_runs_again_counts_once(spark, raw_frame, tmp_path):
    paths = setup(spark, raw_frame, tmp_path, {})
    write_day(tmp_path / "in", "2011-01-04", live("5", "2011-01-04T12:00:00"))
    run(spark, tmp_path, paths)
    once = staged(spark, paths)
    # the state of a crash after the write and before the commit: same query, same batch, again
    shutil.rmtree(tmp_path / "checkpoint" / "commits")
    run(spark, tmp_path, paths)
    assert staged(spark, paths) == once and len(once) == 2
    assert read_all_raw(spark, paths["raw"], paths["stream_raw"]).count() == 2


def test_second_checkpoint_keeps_earlier_lines(spark, raw_frame, tmp_path):
    paths = setup(spark, raw_frame, tmp_path, {})
    write_day(tmp_path / "in", "2011-01-04", live("5", "2011-01-04T12:00:00"))
    run(spark, tmp_path, paths)
    # the checkpoint is lost: old files come again with batch 0 of another query, and a new one with them
    write_day(tmp_path / "in", "2011-01-05", live("6", "2011-01-05T12:00:00"), name="new.json")
    run(spark, tmp_path, paths | {"checkpoint": str(tmp_path / "checkpoint2")})
    assert [r[1] for r in staged(spark, paths)] == ["5", "536365", "6"]
    audit = read_stream_audit(spark, paths["audit"]).orderBy("recon_at").collect()
    assert [(r.source_lines, r.rows_written, r.repeated_rows, r.balanced) for r in audit] == [(1, 1, 0, True), (2, 1, 1, True)]


def test_every_streamed_line_is_accounted_for(spark, raw_frame, tmp_path):
    paths = setup(spark, raw_frame, tmp_path, {})
    lines = ["{bad", "", live("8", "never"), live("9", "2011-03-01T12:00:00"), live("5", "2011-01-04T12:00:00")]
    write_day(tmp_path / "in", "2011-01-04", *lines)
    run(spark, tmp_path, paths)
    row = read_stream_audit(spark, paths["audit"]).first()
    assert (row.source_lines, row.blank_rows, row.corrupt_rows, row.undated_rows, row.stray_rows, row.rows_written) == (5, 1, 1, 1, 1, 1)
    assert row.balanced and row.status == "stray_rows"
    reasons = sorted(r.reason for r in spark.read.parquet(paths["quarantine"]).collect())
    assert reasons == ["corrupt", "stray", "undated"]


def test_load_then_replay_then_stage(spark, raw_frame, tmp_path):
    paths = setup(spark, raw_frame, tmp_path, {})
    # loaded, not staged yet; the stream that follows is newer
    write_periods(raw_frame({"invoice_no": "7", "invoice_date": datetime(2010, 11, 3)}), paths["raw"], PARTITION)
    write_day(tmp_path / "in", "2011-01-04", live("5", "2011-01-04T12:00:00"))
    run(spark, tmp_path, paths)
    raw = read_all_raw(spark, paths["raw"], paths["stream_raw"])
    S.refresh_stg_orders(spark, raw, paths["stg"])
    assert {r[1] for r in staged(spark, paths)} == {"5", "7", "536365"}


def test_lost_checkpoint_sets_nothing_aside_twice(spark, raw_frame, tmp_path):
    """After a second checkpoint files are repeated as a whole: broken lines, and files of nothing but broken lines."""
    paths = setup(spark, raw_frame, tmp_path, {})
    write_day(tmp_path / "in", "2011-01-05", live("1", "2011-01-05T09:00:00"), "{bad")
    write_day(tmp_path / "in", "2011-01-06", "{worse", live("2", "never"))
    run(spark, tmp_path, paths)
    write_day(tmp_path / "in", "2011-01-07", live("3", "2011-01-07T09:00:00"), "{new")
    run(spark, tmp_path, paths | {"checkpoint": str(tmp_path / "another")})
    assert spark.read.parquet(paths["quarantine"]).count() == 4
    assert spark.read.parquet(paths["stream_raw"]).count() == 2
    audit = sorted(tuple(r) for r in read_stream_audit(spark, paths["audit"]).select("source_lines", "repeated_rows", "corrupt_rows", "undated_rows", "rows_written", "balanced").collect())
    assert audit == [(4, 0, 2, 1, 1, True), (6, 4, 1, 0, 1, True)]


def test_batch_that_stopped_before_its_end(spark, raw_frame, tmp_path):
    """Of a batch without a closing note the files with stored rows count as taken in."""
    paths = setup(spark, raw_frame, tmp_path, {})
    write_day(tmp_path / "in", "2011-01-05", live("1", "2011-01-05T09:00:00"))
    run(spark, tmp_path, paths)
    shutil.rmtree(f"{paths['stream_raw']}/_files/done")
    run(spark, tmp_path, paths | {"checkpoint": str(tmp_path / "another")})
    assert spark.read.parquet(paths["stream_raw"]).count() == 1
