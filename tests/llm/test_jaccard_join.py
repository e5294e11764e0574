import random
import re

import numpy as np
import pyarrow as pa
import pytest

from linetally.llm import jaccard_join
from linetally.llm.jaccard_join import SKETCH, bands, index_entries, pairs_of, parities, places, shingle_sets, similar, without_near_copies

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def sets_of(rows):
    out = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(LOWER))
        out.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return out


def brute_force(rows):
    sets = sets_of(rows)
    own = [-(1 << 63) if i is None else i for i, _ in rows]
    label = {i: i for i in own}
    links = [(own[i], own[j]) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if a and 100 * len(a & b) >= 75 * len(a | b)]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                moved = True
    real = lambda x: None if x == -(1 << 63) else x
    return [(i, len(s), real(label[o])) if s else (i, 0, i) for (i, _), s, o in zip(rows, sets, own, strict=True)]


def corpus(seed, groups=45):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    some = lambda n: [rng.choice(words) for _ in range(n)]
    rows = []
    for _ in range(groups):
        size = rng.choice([3, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 60, 150, 400])
        base = some(size)
        for _ in range(rng.randint(1, 6)):
            x = [rng.choice(words) if rng.random() < rng.choice([0, 0.005, 0.02, 0.05]) else w for w in base]
            x = x[: len(x) - rng.randint(0, max(1, size // 4))] if rng.random() < 0.4 else x
            rows.append((len(rows) + 1000, " ".join(x + some(rng.randint(0, max(1, size // 4)) if rng.random() < 0.3 else 0))))
    passage = some(40)
    return rows + [(len(rows) + 2000 + i, " ".join(passage + some(rng.randint(5, 100)))) for i in range(60)]


def order(rows):
    return sorted(rows, key=str)


def test_same_as_brute_force(frame, edge):
    rows = corpus(1) + [(i, t) for i, t in edge if i not in (5, 7)] + [(20, "one two"), (21, "ONE  two\n"), (22, "a " * 500), (23, "a " * 400)]
    got = [tuple(r)[:3] for r in similar(frame(rows)).collect()]
    assert order(got) == order(brute_force(rows))


def test_large_group_of_near_copies(frame):
    rng = random.Random(5)
    base = [f"v{rng.randrange(900)}" for _ in range(120)]
    rows = [(i, " ".join(w if rng.random() > 0.004 else f"u{rng.randrange(900)}" for w in base)) for i in range(300)]
    got = [tuple(r)[:3] for r in similar(frame(rows)).collect()]
    assert order(got) == order(brute_force(rows))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_index_misses_no_pair(seed):
    """Without pivots: every linked pair of different sets shares as many entries as it must."""
    rows = corpus(seed, 80)
    values, at = shingle_sets(pa.array([t for _, t in rows]))
    sketch = np.random.default_rng(seed).integers(0, 5, SKETCH).astype(np.uint32)
    keys, owner, members = index_entries(values, at, sketch)
    size = np.diff(at)
    pair, times = pairs_of(keys, owner, members[:, 0], size[members[:, 0]], members[:, 2])
    a, b = pair[:, 0], pair[:, 1]
    need = np.maximum(1, np.maximum(members[a, 3], members[b, 3]) - members[a, 4] - members[b, 4])
    found = {tuple(sorted(p)) for p, n, k in zip(members[pair, 0].tolist(), times, need, strict=True) if n >= k}
    sets = sets_of(rows)
    for j, y in enumerate(sets):
        for i, x in enumerate(sets[:j]):
            if x and x != y and 100 * len(x & y) >= 75 * len(x | y):
                assert (i, j) in found, (len(x), len(y))


def test_bands_hold_partners():
    edges = bands(10_000)
    for n in range(1, 3000):
        k = np.searchsorted(edges, n, "right")
        assert 4 * n // 3 < edges[k + 1]


def test_one_of_each_group_stays(frame, edge):
    docs = frame(edge)
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == {i for i, _, c in brute_force(edge) if i == c}


def test_empty(frame):
    assert similar(frame([])).count() == 0 and jaccard_join.without_near_copies(frame([])).count() == 0


@pytest.mark.parametrize("seed", [4, 5])
def test_parities_are_a_lower_bound(seed):
    """Bitmaps never differ in more bits than sets have shingles apart, so no link is dropped by them."""
    rows = corpus(seed, 60)
    values, at = shingle_sets(pa.array([t for _, t in rows] + ["", None]))
    bits = parities(values, at)
    assert not bits[-2:].any()
    sets = [set(values[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
    dropped = 0
    for j, y in enumerate(sets):
        for i, x in enumerate(sets[:j]):
            apart = int(np.bitwise_count(bits[i] ^ bits[j]).sum())
            assert apart <= len(x ^ y) and (len(x ^ y) - apart) % 2 == 0
            dropped += 7 * apart > len(x) + len(y)
            assert not (x and 4 * len(x & y) >= 3 * len(x | y)) or 7 * apart <= len(x) + len(y)
    assert dropped


def test_pairs_with_and_without_parities():
    """Parities only take away pairs that are no links."""
    rows = corpus(6, 60)
    values, at = shingle_sets(pa.array([t for _, t in rows]))
    keys, owner, members = index_entries(values, at, np.ones(SKETCH, np.uint32))
    size, bits = np.diff(at)[members[:, 0]], parities(values, at)[members[:, 0]]
    plain = {tuple(sorted(p)) for p in members[pairs_of(keys, owner, members[:, 0], size, members[:, 2])[0], 0].tolist()}
    fewer = {tuple(sorted(p)) for p in members[pairs_of(keys, owner, members[:, 0], size, members[:, 2], bits)[0], 0].tolist()}
    sets = sets_of(rows)
    linked = {p for p in plain if 4 * len(sets[p[0]] & sets[p[1]]) >= 3 * len(sets[p[0]] | sets[p[1]])}
    assert linked <= fewer < plain


def test_a_common_passage_makes_no_pairs():
    """Sets that share under three quarters, all of it frequent, leave it out of the index and do not meet."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(70)]
    texts = [" ".join(passage + [f"x{rng.randrange(10**9)}" for _ in range(60)]) for _ in range(200)]
    values, at = shingle_sets(pa.array(texts))
    sketch = np.bincount((values >> np.uint64(42)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
    keys, owner, members = index_entries(values, at, sketch)
    assert len(keys) <= 0.3 * len(values)
    pair, _ = pairs_of(keys, owner, members[:, 0], np.diff(at)[members[:, 0]], members[:, 2])
    assert not len(pair)


@pytest.mark.parametrize("seed", [7, 8])
def test_parities_travel_for_smaller_sets_only(seed):
    """Pairs with a larger set are not judged by bitmaps that were not sent."""
    rows = corpus(seed, 60)
    values, at = shingle_sets(pa.array([t for _, t in rows]))
    keys, owner, members = index_entries(values, at, np.ones(SKETCH, np.uint32))
    size, bits = np.diff(at)[members[:, 0]], parities(values, at)[members[:, 0]]
    bits[size > 20] = 0
    met = {tuple(sorted(p)) for p in members[pairs_of(keys, owner, members[:, 0], size, members[:, 2], bits, 20)[0], 0].tolist()}
    sets = sets_of(rows)
    for j, y in enumerate(sets):
        for i, x in enumerate(sets[:j]):
            assert not (x and x != y and 100 * len(x & y) >= 75 * len(x | y)) or (i, j) in met


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_places_lose_no_link(seed):
    """Of a linked pair's meetings as many as it must share stand in the first places of both sets."""
    rows = corpus(seed, 80)
    values, at = shingle_sets(pa.array([t for _, t in rows]))
    sketch = np.random.default_rng(seed).integers(0, 5, SKETCH).astype(np.uint32)
    keys, owner, members = index_entries(values, at, sketch)
    size, shared = np.diff(at)[members[:, 0]], members[:, 3] - members[:, 4]
    pair, times = pairs_of(keys, owner, members[:, 0], size, members[:, 2], place=places(owner), shared=shared)
    enough = times >= np.minimum(shared[pair[:, 0]], shared[pair[:, 1]])
    found = {tuple(sorted(p)) for p in members[pair[enough], 0].tolist()}
    sets = sets_of(rows)
    for j, y in enumerate(sets):
        for i, x in enumerate(sets[:j]):
            assert not (x and x != y and 100 * len(x & y) >= 75 * len(x | y)) or (i, j) in found, (len(x), len(y))


def test_a_family_of_similar_texts_does_not_meet():
    """Texts of one template that are not alike enough make no pairs, however many they are."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(300)]
    texts = []
    for _ in range(60):  # one word in 18 of each is its own: about a quarter of the shingles
        texts.append(" ".join(f"u{rng.randrange(10**9)}" if i % 18 == 0 else w for i, w in enumerate(base)))
    values, at = shingle_sets(pa.array(texts))
    sketch = np.bincount((values >> np.uint64(42)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
    keys, owner, members = index_entries(values, at, sketch)
    size, shared = np.diff(at)[members[:, 0]], members[:, 3] - members[:, 4]
    plain, _ = pairs_of(keys, owner, members[:, 0], size, members[:, 2])
    pair, _ = pairs_of(keys, owner, members[:, 0], size, members[:, 2], place=places(owner), shared=shared)
    assert len(plain) and not len(pair)


def test_a_set_is_not_verified_with_each_of_a_large_group(spark, monkeypatch):
    """Sets that meet all of a large component are verified with some of it, and with all of it before they stay apart."""
    base = [f"b{i}" for i in range(60)]
    near = lambda i, n: " ".join([*base[: 60 - n], *(f"u{i}x{k}" for k in range(n))])
    # 0 to 79 are one component already; 80 to 89 link with all of it, 90 with its last alone, 91 with none
    texts = {i: near(i, 2) for i in range(90)} | {79: near(79, 12), 90: near(79, 12) + " more", 91: near(91, 25)}
    rows = spark.createDataFrame(list(texts.items()), "id long, text string")
    links = spark.createDataFrame([(0, i) for i in range(1, 80)], "a long, b long")
    found = jaccard_join.components(links)
    meet = [(i, j, 30 - (i == 79), 0, j) for i in range(80) for j in range(80, 92)] + [(i, j, 40, i, j) for i in range(80, 90) for j in range(i + 1, 90)]
    pairs = spark.createDataFrame(meet, "a long, b long, n long, from long, to long")
    verified, linked = [], jaccard_join._linked
    monkeypatch.setattr(jaccard_join, "_linked", lambda pairs, sets: verified.extend(map(tuple, pairs.select("a", "b").collect())) or linked(pairs, sets))
    links, found = jaccard_join._verified(pairs, rows, links, found, lambda df, label: jaccard_join.written(df, label))
    assert {r["v"] for r in found.collect() if r["label"] == 0} == set(range(91))
    assert len(set(verified)) == len(verified) and {(i, 91) for i in range(80)} <= set(verified)
    assert len(verified) < len(meet) / 3
