import hashlib
import random

import pytest

from linetally.llm.repeats import merge_runs, without_repeats


def brute_force(rows):
    first, out = {}, []
    texts = [(-(1 << 63) if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(first.get(b[p : p + 50], i), i)
    for (i, b), (given, _) in zip(texts, rows, strict=True):
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        spans = sum(gone[k] and (not k or not gone[k - 1]) for k in range(len(b)))
        out.append((given, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_loser_tree():
    rng = random.Random(1)
    for runs in (1, 2, 3, 7):
        strings = [sorted(bytes(rng.choice(b"ab") for _ in range(6)) for _ in range(rng.randint(0, 30))) for _ in range(runs)]
        lcp = lambda a, b: next((k for k in range(6) if a[k] != b[k]), 6)
        common = [[0, *(lcp(a, b) for a, b in zip(s, s[1:], strict=False))][: len(s)] for s in strings]
        order, shared = merge_runs(strings, common)
        heads = [iter(s) for s in strings]
        merged = [next(heads[r]) for r in order]
        assert merged == sorted(x for s in strings for x in s)
        assert shared[1:] == [lcp(a, b) for a, b in zip(merged, merged[1:], strict=False)]


@pytest.mark.parametrize("range_rows", [40, 300_000])
def test_same_as_brute_force(frame, edge, range_rows):
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    common = [noise(60) for _ in range(5)] + ["a" * 80, "ab" * 60]
    rows = [(100 + i, noise(rng.randint(0, 150)) + rng.choice(common) + noise(rng.randint(0, 90)) + rng.choice(common)[rng.randint(0, 12) :]) for i in range(90)]
    rows += [(90, "x" * 49), (91, "x" * 50), (92, "x" * 51), (93, "\0" * 60), (94, "\0" * 55), (95, noise(3) + "\0" * 52 + "z"), (100, rows[0][1])]
    rows += [(i, t if len(t or "") < 50_000 else t[:30_000]) for i, t in edge]
    got = [tuple(r)[:5] for r in without_repeats(frame(rows), range_rows=range_rows, with_kept=False).collect()]
    assert sorted(got, key=str) == sorted(brute_force(rows), key=str)


def test_kept_bytes(frame):
    a, b = "the quick brown fox jumps over the lazy dog again and again", "some words before "
    rows = {r["doc_id"]: r for r in without_repeats(frame([(1, a), (2, b + a + " end")])).collect()}
    assert rows[1]["kept"] == a.encode() and rows[2]["kept"] == (b + " end").encode().replace(b"  ", b"  ")


def test_empty(frame):
    assert without_repeats(frame([])).count() == 0


def test_many_documents_still_give_bounds(spark, monkeypatch):
    from pyspark.sql import functions as F

    from linetally.llm import repeats

    monkeypatch.setattr(repeats, "SAMPLED_DOCS", 8)
    n = 9_000_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("hash"), F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(x)), 256) for x in "ab"]).alias("text"))
    assert len(repeats._bounds(docs, n, 4)) == 3
