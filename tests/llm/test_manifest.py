"""Merkle manifests against a plain recursion over all rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from linetally.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, place long, digest string, at int"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def fold(nodes):
    """The root of ``nodes`` and each one's siblings, level by level."""
    at = list(range(len(nodes)))
    proofs = [[] for _ in nodes]
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for k, i in enumerate(at):
            run = runs[i // 16]
            proofs[k].append((i % 16, run[: i % 16] + run[i % 16 + 1 :]))
        at = [i // 16 for i in at]
        nodes = [H("".join(r)) for r in runs]
    return nodes[0], proofs


def plain(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        members = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = members, *fold([leaf_of(r) for r in members])
    root, above = fold([trees[s][1] for s in order])
    out = []
    for s, top in zip(order, above):
        members, subroot, proofs = trees[s]
        for row, proof in zip(members, proofs):
            whole = proof + top
            held = leaf_of(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                held = leaf_of((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            got = held
            for slot, others in whole:
                got = H("".join(others[:slot] + [got] + others[slot:]))
            out.append((row[0], leaf_of(row), subroot, root, H("".join(d for _, o in whole for d in o)), got, got == root))
    return out


def run(spark, rows, **more):
    docs = spark.createDataFrame([(*r, "t", 5, "d", 1) for r in rows], SCHEMA)
    lost = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    probe = manifest.row_digest(*[lost if f == "text" else F.col(f) for f in manifest.FIELDS])
    return manifest.manifest(docs, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, probe), **more)


def key(row):
    return tuple((v is not None, v) if v is not None else (False, 0) for v in row)


@pytest.mark.parametrize("sizes", [(1,), (257, 256, 17, 16, 1), (4100, 3, *[1] * 40)])
def test_same_as_plain(spark, sizes):
    rng = random.Random(len(sizes))
    rows = []
    for s, n in enumerate(sizes):
        for _ in range(n):
            rows.append((rng.randrange(10**6), f"s{s}é" if s else None, rng.choice(["en", None]), rng.randrange(99), rng.choice(["Some Text", "plain", "", None, "É A漢"])))
    got = [tuple(r) for r in run(spark, rows).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_edges(spark):
    """Nulls everywhere, ids and whole rows that repeat, a long text, one source with nearly all rows."""
    rows = [(None, None, None, None, None)] * 3 + [(5, "a", "en", 1, "X")] * 300 + [(5, "a", "en", 2, "Y" * 200_000), (7, "", "en", 0, ""), (8, "b", None, 3, "é:-")]
    got = [tuple(r) for r in run(spark, rows).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    assert not run(spark, []).collect()


def test_proofs_lead_to_the_root(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(700)]
    for r in run(spark, rows, with_proofs=True).collect():
        assert manifest.folded(r["leaf"], r["slots"], r["siblings"]) == r["root"]
        assert r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0)
