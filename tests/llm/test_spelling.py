"""Spelling variants against a comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from linetally.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain(rows, noise=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=lambda r: r[0])


def got(found):
    return sorted(map(tuple, found.collect()), key=lambda r: r[0])


def edited(rng, word, letters):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1 :], word + rng.choice(letters)])


@pytest.mark.parametrize(("letters", "together"), [("ab", 3), ("abcdeé", 64)])
def test_same_as_all_pairs(frame, letters, together):
    """Few letters: nearly every word has neighbours, and groups have to be divided down to one code point."""
    rng = random.Random(len(letters))
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 12))) for _ in range(60)]
    words = [w for w in base for _ in range(rng.choice([1, 2, 30, 400]))] + [edited(rng, rng.choice(base), letters) for _ in range(900)]
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)]
    assert got(spelling.variants(frame(rows), noise=31, most_together=together)) == plain(rows)


def test_hot_prefix_and_suffix(frame):
    """A third of the vocabulary begins alike and another third ends alike."""
    rng = random.Random(1)
    tail = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    words = ["interna" + tail() for _ in range(400)] + [tail() + "ization" for _ in range(400)]
    rows = [(i, " ".join(words)) for i in range(2)]
    assert got(spelling.variants(frame(rows), most_together=8)) == plain(rows, None)


def test_edges(frame, edge):
    """Chains of forms, ties, very long words, letters beyond A-Z, nulls, repeated rows and an empty table."""
    chain = "abcdefgh " * 2 + "abcdefgx " * 30 + "abcdefyx " * 400
    ties = "zzzzzzzb " * 50 + "zzzzzzza " * 50 + "zzzzzzzz " * 2
    long = "q" * 3000
    rows = [*edge, (20, chain), (21, ties), (22, f"{long} {long} {long}x {long}x"), (23, "ÀÉÎõüÿß àéîõüÿß ÀÉÎõüÿß àéîõüÿß ÀÉÎõüÿs ÀÉÎõüÿs"), (None, "nullwords nullwords nullword nullword")]
    found = got(spelling.variants(frame(rows), noise=31))
    assert found == plain(rows)
    assert {r[0]: r[2] for r in found}["abcdefgh"] == "abcdefyx"
    assert {r[0]: r[1] for r in found}["zzzzzzzz"] == "zzzzzzza"
    assert not spelling.variants(frame([])).collect()
