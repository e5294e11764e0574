import json

import pytest
from conftest import dicts, raw_row

from linetally.plans import recon as N
from linetally.plans import staging as S
from linetally.schemas import RAW_ORDER
from pyspark.sql import functions as F


def record(period, back, balanced=True, run="r1", at="2011-02-01T00:00:00+00:00", **more):
    return json.dumps(
        {
            "run_id": run, "job_name": "j", "period": period, "recon_at": at, "source_lines": 9, "corrupt_rows": 0,
            "undated_rows": 0, "expected_rows": 9, "rows_written_back": back, "difference": 0, "balanced": balanced,
            "quality": {"rows_total": 9, "cancellations": 2},
        } | more,
        indent=2,
    )


def recon_raw(spark, *records):
    df = spark.createDataFrame([(r,) for r in records], "value string")
    return df.select(F.expr("parse_json(value)").alias("recon_record"), F.lit("f").alias("source_file"), F.current_timestamp().alias("loaded_at"))


def raw(spark, **rows_per_month):
    rows = []
    for key, n in rows_per_month.items():
        rows += [raw_row(partition_year=2011, partition_month=int(key[1:]), quantity=i) for i in range(n)]
    return spark.createDataFrame(rows, RAW_ORDER)


@pytest.fixture
def six(spark):
    """One period for every status, and one with an unknown count."""
    audit = recon_raw(
        spark,
        record("2011-01", 2),
        record("2011-02", 2),
        record("2011-03", 3, balanced=False),
        record("2011-04", 9),
        record("2011-05", 2),
        record("2011-07", None),
    )
    loaded = raw(spark, m1=2, m3=3, m4=2, m5=2, m6=2, m7=2)
    staged = S.stg_orders(loaded).where("not (period = '2011-05' and quantity = 1)")
    return N.pipeline_reconciliation(S.stg_glue_recon(audit), loaded, staged)


def test_six_statuses(six):
    assert {r.period: r.recon_status for r in six.collect()} == {
        "2011-01": "ok",
        "2011-02": "not_loaded_to_snowflake",
        "2011-03": "glue_unbalanced",
        "2011-04": "s3_to_snowflake_mismatch",
        "2011-05": "snowflake_to_staging_mismatch",
        "2011-06": "no_glue_record",
        # a NULL count does not match any branch
        "2011-07": "ok",
    }
    row = six.where("period = '2011-04'").first()
    assert (row.s3_to_snowflake_diff, row.snowflake_to_staging_diff) == (-7, 0)


def test_period_only_in_staging_is_one_row(spark):
    loaded = raw(spark, m1=1)
    out = N.pipeline_reconciliation(S.stg_glue_recon(recon_raw(spark, record("2011-09", 1))), loaded.limit(0), S.stg_orders(loaded))
    assert sorted((r.period, r.recon_status) for r in out.collect()) == [
        ("2011-01", "no_glue_record"),
        ("2011-09", "not_loaded_to_snowflake"),
    ]


def test_streamed_lines_are_counted_out_of_staging(spark):
    batch, live = raw(spark, m1=2), raw(spark, m1=3)
    glue = S.stg_glue_recon(recon_raw(spark, record("2011-01", 2)))
    staged = S.stg_orders(batch.unionByName(live))
    assert N.pipeline_reconciliation(glue, batch, staged).first().recon_status == "snowflake_to_staging_mismatch"
    row = N.pipeline_reconciliation(glue, batch, staged, streamed=live).first()
    assert (row.recon_status, row.dbt_staging_rows, row.snowflake_to_staging_diff) == ("ok", 2, 0)


def test_gate(six):
    N.require_reconciled(six, ["2011-01"])
    with pytest.raises(N.ReconciliationError, match="2011-04: s3_to_snowflake_mismatch"):
        N.require_reconciled(six, ["2011-01", "2011-04"])
    with pytest.raises(N.ReconciliationError, match="1999-01: no_reconciliation_row"):
        N.require_reconciled(six, ["1999-01"])
    with pytest.raises(N.ReconciliationError, match="2011-07: unknown_counts"):
        N.require_reconciled(six, ["2011-07"])
    assert N.gate_findings(six).count() == 6


def test_report(six):
    assert [r.period for r in N.status_report(six).collect()] == [f"2011-0{m}" for m in range(1, 8)]
    assert N.overall_state(six) == "FAILED"
    assert N.overall_state(six.where("period = '2011-01'")) == "SUCCESS"


def test_latest_record_wins_and_history_stays(spark):
    audit = recon_raw(
        spark,
        record("2011-01", 1, False, "old", "2011-02-01T00:00:00+00:00"),
        record("2011-01", 5, True, "new", "2011-02-02T00:00:00+01:00"),
    )
    row = S.stg_glue_recon(audit).collect()
    assert [(r.run_id, r.rows_written_back, r.glue_balanced, r.q_cancellations) for r in row] == [("new", 5, True, 2)]
    # a field the record lacks is NULL
    assert row[0].q_null_customer_id is None
    loaded = raw(spark, m1=5)
    assert dicts(N.recon_vs_loaded(audit, loaded), "run_id") == [
        {"period": "2011-01", "run_id": "new", "glue_wrote": 5, "rows_loaded": 5, "difference": 0},
        {"period": "2011-01", "run_id": "old", "glue_wrote": 1, "rows_loaded": 5, "difference": 4},
    ]


def test_audit_files_are_loaded_once(spark, tmp_path):
    folder, table = tmp_path / "audit" / "job=j" / "period=2011-01", str(tmp_path / "ops")
    folder.mkdir(parents=True)
    (folder / "r1.json").write_text(record("2011-01", 1, run="r1"))
    S.load_recon_raw(spark, str(tmp_path / "audit"), table)
    (folder / "r2.json").write_text(record("2011-01", 2, run="r2"))
    S.load_recon_raw(spark, str(tmp_path / "audit"), table)
    S.load_recon_raw(spark, str(tmp_path / "audit"), table)
    fields = S.recon_fields(spark.read.parquet(table))
    assert sorted(r.run_id for r in fields.collect()) == ["r1", "r2"]


def test_volume_anomaly(spark):
    stg = S.stg_orders(raw(spark, m1=2, m2=4, m3=3, m4=30))
    got = [(r.period, r.prior_average, r.volume_ratio) for r in N.volume_anomaly(stg).orderBy("period").collect()]
    assert got == [("2011-01", None, None), ("2011-02", 2.0, 2.0), ("2011-03", 3.0, 1.0), ("2011-04", 3.0, 10.0)]
