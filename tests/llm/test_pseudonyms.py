import re

import pytest
from pyspark.sql import functions as F

from linetally.llm.pseudonyms import permuted, pseudonymised


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0


def run(spark, texts, key="k", **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r["text"], {k: n for k, n in r["pii_found"].items() if n}) for r in pseudonymised(docs, key, **more).orderBy("doc_id").collect()]


TEXTS = [
    "card 4041894974608795 and 4041 8949 7460 8795.", "mail hoc.96@mail8.example.com, A-b+c@d.co.uk", "call +1 (988) 555-2485 or +1 988-555-2485!",
    "from 70.123.182.155", "on 2011-02-28, 28/02/2011 and 28.02.2011", "ssn 123-45-6789", "a@b.com", "x" * 3000 + " 4041894974608795 " + "y" * 3000,
]


def test_formats_hold_and_values_stay_linked(spark):
    got = run(spark, TEXTS)
    cards = re.findall(r"\d{16}", got[0][0].replace(" ", ""))
    assert len(cards) == 2 and cards[0] == cards[1] != "4041894974608795" and luhn(cards[0]) and cards[0][0] == "4"
    assert cards[0] in got[7][0] and len(got[7][0]) == len(TEXTS[7])
    assert re.fullmatch(r"mail [a-z]{3}\.\d\d@mail8\.example\.com, [A-Z]-[a-z]\+[a-z]@d\.co\.uk", got[1][0])
    phones = re.findall(r"\d+", got[2][0])
    assert phones[1:4] == phones[5:8] and re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \+1 \d{3}-\d{3}-\d{4}!", got[2][0])
    assert all(int(x) < 256 for x in re.findall(r"\d+", got[3][0]))
    y, m, d = re.search(r"(\d{4})-(\d\d)-(\d\d)", got[4][0]).groups()
    assert got[4][0] == f"on {y}-{m}-{d}, {d}/{m}/{y} and {d}.{m}.{y}"
    area, group, serial = map(int, re.search(r"(\d{3})-(\d\d)-(\d{4})", got[5][0]).groups())
    assert 0 < area < 900 and area != 666 and group and serial
    assert [k for _, k in got] == [{"card": 2}, {"email": 2}, {"phone": 2}, {"ip": 1}, {"date": 3}, {"ssn": 1}, {"email": 1}, {"card": 1}]
    for old, (new, _) in zip(TEXTS, got, strict=True):
        assert old != new
    assert got != run(spark, TEXTS, key="another")


def test_key_turns_back(spark):
    hidden = [t for t, _ in run(spark, TEXTS)]
    assert [t for t, _ in run(spark, hidden, decrypt=True)] == TEXTS


def test_values_that_are_not_valid_stay(spark):
    texts = ["4041894974608796", "999.1.1.1", "1.2.3.4.5", "v4.0.", "2011-02-30", "1899-12-31", "31/02/2011", "000-12-3456", "666-12-3456", "12345", "a@b", "12-2011-02-28-1"]
    assert run(spark, texts) == [(t, {}) for t in texts]


@pytest.mark.parametrize(("a", "b"), [(5, 7), (1, 30), (16, 16)])
def test_permutation(spark, a, b):
    grid = spark.range(a * b).select((F.col("id") / b).cast("long").alias("x"), (F.col("id") % b).alias("y"))
    there = grid.withColumn("p", permuted(F.col("x"), F.col("y"), a, b, F.lit("key"), "test"))
    back = there.withColumn("q", permuted(F.col("p.x"), F.col("p.y"), a, b, F.lit("key"), "test", decrypt=True)).collect()
    assert len({tuple(r["p"]) for r in back}) == a * b and all(0 <= r["p"]["x"] < a and 0 <= r["p"]["y"] < b for r in back)
    assert all(tuple(r["q"]) == (r["x"], r["y"]) for r in back)


def test_edges(frame, edge):
    docs = frame(edge + [(60, "4041894974608795")])
    got = pseudonymised(docs, "k")
    assert got.columns == [*docs.columns, "pii_found"]
    same = {(r["doc_id"], r["text"]) for r in got.collect()}
    assert {(i, t) for i, t in edge} <= same and (60, "4041894974608795") not in same
    assert pseudonymised(frame([]), "k").count() == 0
    assert not re.search("Python|Pandas|Arrow", got._jdf.queryExecution().toString())


def card_of(digits):
    return next(digits + c for c in "0123456789" if luhn(digits + c))


CARDS = [card_of("4" + "123456789012345678"[: n - 2]) for n in range(13, 20)]
PHONES = ["(555) 123-4567", "555-123-4567", "555.123.4567", "1-555-123-4567", "+44 20 7946 0958", "+442079460958", "+49 (0)30 901820", "+353 1 234 5678", "+7 495 123-45-67"]


def test_other_card_lengths_and_phones(spark):
    grouped = ["3782 822463 10005", "3782-822463-10005", "3056 930902 5904", "-".join(CARDS[6][i : i + 4] for i in range(0, 19, 4))]
    values = CARDS + grouped + PHONES
    texts = [f"value {v}, here" for v in values]
    got = run(spark, texts)
    for v, t, (new, found) in zip(values, texts, got, strict=True):
        assert found == {"phone" if v in PHONES else "card": 1} and new != t, v
        assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", t)
        if v not in PHONES:
            assert luhn(re.sub(r"\D", "", new)) and new[6] == v[0]
    digits = dict(zip(values, (re.sub(r"\D", "", new) for new, _ in got), strict=True))
    assert digits["(555) 123-4567"] == digits["555.123.4567"] == digits["1-555-123-4567"][1:] == run(spark, ["+1 555 123 4567"])[0][0].replace(" ", "")[2:]
    assert digits["+44 20 7946 0958"] == digits["+442079460958"] and digits["+353 1 234 5678"].startswith("353")
    assert [t for t, _ in run(spark, [t for t, _ in got], decrypt=True)] == texts
    wrong = ["378282246310006", "4123456789013", "12345678901234567890", "+44 123", "2024.12.01", "1.2.3.4.5"]
    wrong = [w for w in wrong if not (w.isdigit() and luhn(w))]
    assert run(spark, wrong) == [(w, {}) for w in wrong]
