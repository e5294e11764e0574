import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linetally.llm import tokens
from linetally.llm.packing import best_filling, pack_pool, packed

WORD = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=12), st.integers(60, 90))
def test_filling_is_the_best_there_is(lengths, window):
    counts = Counter(lengths)
    longest = max(lengths)
    sums = {longest}
    rest = list(lengths)
    rest.remove(longest)
    for n in rest:
        sums |= {s + n for s in sums if s + n <= window}
    used = best_filling(dict(counts), window)
    assert used[longest] >= 1 and all(used[n] <= counts[n] for n in used)
    assert sum(n * c for n, c in used.items()) == max(sums)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=60))
def test_pool_is_cut_into_full_windows(lengths):
    out = pack_pool(lengths, 64)
    covered = defaultdict(list)
    for pieces in out:
        for item, at, n in pieces:
            covered[item].append((at, at + n))
    for item, n in enumerate(lengths):
        spans = sorted(covered[item])
        assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    sizes = [sum(n for _, _, n in pieces) for pieces in out]
    assert sizes.count(64) == sum(lengths) // 64
    tail = [s for s in sizes if s != 64]
    assert len(set(tail)) == len(tail) and all(s & (s - 1) == 0 for s in tail)


@pytest.mark.parametrize("pool", [200, 1 << 20])
def test_pieces_hold_all_ids_once(frame, edge, pool):
    rng = random.Random(2)
    rows = [(i, t) for i, t in edge if i is not None and (i, t) != (7, edge[10][1])]
    rows = list(dict(rows).items()) + [(100 + i, "same words here " * rng.choice([3, 3, 3, 50])) for i in range(60)]
    got = packed(frame(rows), WORD, window=256, pool_tokens=pool).toPandas()
    tokenizer = Tokenizer.from_file(WORD)
    tokenizer.encode_special_tokens = True
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = got[got.doc_id == i].sort_values("start")
        assert own.length.sum() == len(ids) and set(own.doc_tokens) == {len(ids)}
        for r in own.itertuples():
            part = ids[r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(part.tobytes()) and (np.frombuffer(r.ids, "<u2") == part).all()
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert (s.length.cumsum() - s.length == s.offset).all()
        n = s.length.sum()
        assert n == 256 or n & (n - 1) == 0


def test_empty(frame):
    assert packed(frame([]), WORD).count() == 0


ODD = ["a\t b", "a  b", "x\n y", " lead", "trail \n", "\n\nq", "a\x1cb c", "don't  stop's <|endoftext|> x", "é́ ́a Σας ΣΑΣ", "a　b c", " ", "a \nb", "x Don't, DON'T. 5, ½, q", "x !, a!, ., ,, b.", "x İ, ẞ. ſ,"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_alone_read_as_in_their_text(name, monkeypatch, edge):
    monkeypatch.setattr(tokens, "PART", 200)
    reader = tokens.WordTokenizer(public_tokenizers.path(name), kept_bytes=100_000)
    texts = ODD + [t for _, t in edge if t and len(t) < 100_000]
    for text, ids in zip(texts, reader.many(texts), strict=True):
        assert ids.tolist() == reader.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_frequent_words_are_encoded_once(name, monkeypatch):
    """What is kept goes by texts that do not use it, so words in all texts stay; new words are read without offsets."""
    reader = tokens.WordTokenizer(public_tokenizers.path(name), kept_bytes=60_000)
    learned = Counter()
    learn = reader._learn
    monkeypatch.setattr(reader, "_learn", lambda words: learned.update(words) or learn(words))
    slow = []
    offsets = reader._by_offsets
    monkeypatch.setattr(reader, "_by_offsets", lambda words: slow.extend(words) or offsets(words))
    for i in range(20):
        text = "the same words again, don't stop. " * 3 + " ".join(f"rare{i}x{k}|" if k == 0 else f"rare{i}x{k}" for k in range(100))
        assert reader.ids(text).tolist() == reader.tokenizer.encode(text, add_special_tokens=False).ids
        assert reader.held <= 60_000
    assert learned["same"] == learned["again"] == learned["stop"] == 1 and len(reader.kept) < 2000
    assert slow == [f"rare{i}x0|" for i in range(20)]
