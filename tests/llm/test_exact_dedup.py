import hashlib
from collections import defaultdict

import pytest

from linetally.llm.exact_dedup import exact_dedup, without_copies


def wanted(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        own = groups[t or ""]
        keep = max((x for x in own if x is not None), default=None) if len(own) > 1 else i
        out.append((i, keep, len(own), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("chunks", [1, 8])
def test_same_as_brute_force(frame, edge, chunks):
    # forty thousand rows on one chunk: the filter is full and results are the same
    rows = edge + [(100 + i, f"text {i // 3 if i < 90 else i}") for i in range(3000)] + [(9000 + i, "hot") for i in range(1500)]
    got = [tuple(r) for r in exact_dedup(frame(rows), most_chunks=chunks).collect()]
    assert order(got) == order(wanted(rows))


def test_rows_without_a_copy_are_not_shuffled(frame):
    rows = [(i, f"t{i}") for i in range(400)] + [(1000, "t0"), (1001, "t1")]
    out = exact_dedup(frame(rows))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the first side of the union, the rows without a copy, reads its table and meets the filter where it stands
    assert "Exchange hashpartitioning" not in plan.split("Union")[1].split("Scan parquet")[0]


def test_one_row_of_each_text_stays(frame, edge):
    docs = frame(edge)
    kept = without_copies(docs)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(rows) == len({t or "" for _, t in edge})
    top = {}
    for i, t in edge:
        top[t or ""] = max(top.get(t or "", -1), -1 if i is None else i)
    assert {t or "": -1 if i is None else i for i, t in rows} == top


def test_empty(frame):
    assert exact_dedup(frame([])).count() == 0 and without_copies(frame([])).count() == 0
