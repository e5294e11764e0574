import gzip

from conftest import dicts, landed, write_day

from linetally.plans.convert import period_metrics, quality_metrics, set_aside
from linetally.sources.landing import corrupt_sample, good, parse_lines, read_lines, stray


def parsed(spark, tmp_path, *lines, day="2011-01-04"):
    write_day(tmp_path, day, *lines)
    return parse_lines(read_lines(spark, str(tmp_path)))


def test_every_line_is_exactly_one_kind(spark, tmp_path):
    p = parsed(
        spark,
        tmp_path,
        landed(),
        "{bad",
        "",
        landed(quantity="x"),
        landed(quantity=5.0),
        landed(quantity=5.5),
        landed(invoice_date="soon"),
        landed(description="café crème"),
    )
    m = period_metrics(p).first()
    assert (m.source_lines, m.corrupt_rows, m.undated_rows, m.rows_total) == (8, 4, 1, 3)
    assert p.where("is_blank").count() == 1
    assert {r.description for r in good(p).collect()} == {"WHITE HANGING HEART", "café crème"}


def test_several_records_on_one_line_are_corrupt(spark, tmp_path):
    p = parsed(spark, tmp_path, f"[{landed()},{landed()}]", landed())
    assert period_metrics(p).first().corrupt_rows == 1


def test_values_pass_through_untouched(spark, tmp_path):
    line = landed(invoice_no="C1", quantity=-3, unit_price=-1.5, customer_id=None, description="  x ")
    row = good(parsed(spark, tmp_path, line, line)).collect()
    assert len(row) == 2
    assert (row[0].invoice_no, row[0].quantity, row[0].unit_price) == ("C1", -3, -1.5)
    assert row[0].customer_id is None and row[0].description == "  x "
    assert (row[0].year, row[0].month, row[0].path_period) == (2011, 1, "2011-01")


def test_period_filter_prunes_folders(spark, tmp_path):
    write_day(tmp_path, "2011-01-31", landed())
    write_day(tmp_path, "2011-02-01", landed(invoice_date="2011-02-01T00:00:00"))
    lines = read_lines(spark, str(tmp_path), ["2011-02"])
    assert lines.count() == 1
    # the other month is not even listed
    assert len(lines.inputFiles()) == 1 and lines.select("event_date").first()[0] == "2011-02-01"


def test_other_objects_are_not_read(spark, tmp_path):
    write_day(tmp_path, "2011-01-04", landed())
    (tmp_path / "event_date=2011-01-04" / "orders_$folder$").write_text("")
    assert read_lines(spark, str(tmp_path)).count() == 1


def test_stray_lines(spark, tmp_path):
    p = parsed(spark, tmp_path, landed(), landed(invoice_date="2011-02-01T00:00:00"), landed(invoice_date=None))
    assert [r.invoice_date.month for r in stray(p).collect()] == [2]


def test_quality_metrics_of_nothing_are_zero(spark, tmp_path):
    p = parsed(spark, tmp_path, "{bad")
    assert set(quality_metrics(p).first().asDict().values()) == {0}


def test_quality_metrics(spark, tmp_path):
    p = parsed(
        spark,
        tmp_path,
        landed(),
        landed(invoice_no=None, customer_id=None),
        landed(invoice_no="C9", quantity=-1, unit_price=0.0),
        landed(invoice_date=""),
        "{bad",
    )
    assert quality_metrics(p).first().asDict() == {
        "rows_total": 4,
        "null_invoice_no": 1,
        "null_customer_id": 1,
        "negative_quantity": 1,
        "non_positive_price": 1,
        "cancellations": 1,
        "unparseable_date": 1,
    }


def test_corrupt_sample_is_repeatable(spark, tmp_path):
    p = parsed(spark, tmp_path, "{d", "{b", landed(), "{a", "{c")
    assert [r.line for r in corrupt_sample(p, 3).collect()] == ["{a", "{b", "{c"]


def test_set_aside_keeps_the_text(spark, tmp_path):
    undated = landed(invoice_date="soon")
    p = parsed(spark, tmp_path, landed(), "{bad", undated, "")
    assert dicts(set_aside(p), "reason") == [
        {"period": "2011-01", "reason": "corrupt", "line": "{bad"},
        {"period": "2011-01", "reason": "undated", "line": undated},
    ]


def test_numbers_that_are_not_finite_are_corrupt(spark, tmp_path):
    write_day(tmp_path, "2011-01-04", landed(), landed(unit_price=float("nan")), landed(unit_price=float("inf")))
    parsed = parse_lines(read_lines(spark, str(tmp_path)))
    assert parsed.where("is_corrupt").count() == 2 and good(parsed).count() == 1


def test_gzipped_lines_are_read_beside_plain_ones(spark, tmp_path):
    write_day(tmp_path, "2011-01-04", landed(), "{bad")
    for name in ("part-0.txt.gz", "part-1.json.gz"):
        with gzip.open(tmp_path / "event_date=2011-01-04" / name, "wt", encoding="utf-8") as f:
            f.write(landed(description="café") + "\n")
    (tmp_path / "event_date=2011-01-04" / "marker.gz").write_bytes(b"")
    for periods in (None, ["2011-01"]):
        p = parse_lines(read_lines(spark, str(tmp_path), periods))
        assert p.count() == 4 and sorted(r.description for r in good(p).collect()) == ["WHITE HANGING HEART", "café", "café"]
