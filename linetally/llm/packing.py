"""Packing by minimum bin slack: whole documents into windows of a fixed number of tokens, almost without padding.

Each task packs the documents of its own partition, pool by pool, so nothing is shuffled and a pool is bounded by
``pool_tokens`` whatever the input. A document longer than the window gives full windows of its own; what remains of it
(or the whole short document) goes into the pool. A pool is reduced to a histogram of remaining lengths, and windows are
filled from that histogram:

* the longest remaining length is set, and a subset-sum over the remaining multiset, held as the bits of one integer,
  says which fillings can be reached; lengths enter from the longest down until the window can be filled to the last
  token or none is left;
* the filling nearest to the window is traced back to counts per length, and that pattern is used for as many windows
  as the counts allow, so a hot length costs one solution and not one per window;
* slack that no subset can close is filled by cutting the longest document left.

The last window of a pool is partly filled. It is cut into sequences whose lengths are powers of two, which need no
padding.

Rows: null and empty texts are the end id alone (one piece of one token). Rows that repeat, or share an id, are packed
each for itself. Other columns are not looked at. An empty table gives an empty result. Results repeat for the same
files and settings; partitions and pools decide which documents share a window.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetally.llm.common import ship, slices
from linetally.llm.tokens import word_tokenizer

WINDOW = 4096
END_ID = 2
#: Tokens of remaining documents that a task holds before it packs them (two or four bytes each).
POOL_TOKENS = 1 << 23
#: Bytes of text tokenized at once.
STEP = 4 << 20

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_length long, ids binary"
)


def best_filling(counts: dict[int, int], window: int) -> dict[int, int]:
    """How many of each length fill a window closest, the longest length being used at least once.

    ``counts``: lengths, 1 to ``window``, with how many of them remain (at least one in all).
    """
    lengths = sorted(counts, reverse=True)
    longest = lengths[0]
    room = window - longest
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []  # bit s of reach: s tokens can be filled
    for length in lengths:
        if reach >> room & 1:
            break
        left = min(counts[length] - (length == longest), room // length)
        take = 1
        while left > 0:  # counts in powers of two: few shifts for many copies
            take = min(take, left)
            steps.append((length, take, reach))
            reach = (reach | reach << length * take) & full
            left -= take
            take *= 2
    filled = reach.bit_length() - 1
    used = Counter({longest: 1})
    for length, take, before in reversed(steps):
        if not before >> filled & 1:
            used[length] += take
            filled -= length * take
    return dict(used)


def fill_windows(counts: dict[int, int], window: int) -> Iterator[tuple[dict[int, int], int, int]]:
    """Patterns of lengths, how often each is used, and the slack that a cut has to close.

    Ends when what remains is under one window; ``counts`` then holds it. After a pattern with slack (used once) the
    caller cuts so many tokens off a remaining document and corrects ``counts``.
    """
    left = sum(n * c for n, c in counts.items())
    while left >= window:
        used = best_filling(counts, window)
        slack = window - sum(n * c for n, c in used.items())
        times = 1 if slack else min(counts[n] // c for n, c in used.items())
        for n, c in used.items():
            counts[n] -= c * times
            if not counts[n]:
                del counts[n]
        yield used, times, slack
        left -= window * times  # what a cut adds to a pattern with slack is taken from the rest


def pack_pool(lengths: list[int], window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, first token in the item, tokens); each item is shorter than a window.

    All sequences are full but the last ones, whose lengths are different powers of two.
    """
    by_length: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for item, n in reversed(list(enumerate(lengths))):
        by_length[n].append((item, 0))
    counts = {n: len(x) for n, x in by_length.items()}
    out = []
    for used, times, slack in fill_windows(counts, window):
        for _ in range(times):
            out.append([(*by_length[n].pop(), n) for n, c in used.items() for _ in range(c)])
        if slack:
            # any length left is longer than the slack, else it would have been used
            n = max(counts)
            item, at = by_length[n].pop()
            out[-1].append((item, at, slack))
            counts[n] -= 1
            if not counts[n]:
                del counts[n]
            rest = n - slack
            by_length[rest].append((item, at + slack))
            counts[rest] = counts.get(rest, 0) + 1
    tail = [(item, at, n) for n in sorted(counts, reverse=True) for item, at in by_length[n]]
    left = sum(n for _, _, n in tail)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out.append([])
        while room:
            item, at, n = tail.pop(0)
            take = min(n, room)
            out[-1].append((item, at, take))
            room -= take
            if take < n:
                tail.insert(0, (item, at + take, n - take))
    return out


def packed(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    pool_tokens: int = POOL_TOKENS,
    with_ids: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: its document and place there, its sequence and place there, and (``with_ids``) its ids,
    little-endian, two or four bytes each by the size of the vocabulary; null without ``with_ids``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer)
        end = np.array([end_id], words.dtype)
        sequence = TaskContext.get().partitionId() << 40
        pool: list[tuple[int | None, int, int, np.ndarray]] = []  # id, start, tokens of the document, ids
        held = 0
        rows: list[tuple] = []

        def piece(doc, start, total, ids, at, size) -> None:
            crc = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
            rows.append((doc, start, len(ids), crc, total, sequence, at, size, ids.tobytes() if with_ids else None))

        def flush() -> None:
            nonlocal sequence, held
            for pieces in pack_pool([len(x[3]) for x in pool], window):
                at, size = 0, sum(n for _, _, n in pieces)
                for item, first, n in pieces:
                    doc, start, total, ids = pool[item]
                    piece(doc, start + first, total, ids[first : first + n], at, size)
                    at += n
                sequence += 1
            pool.clear()
            held = 0

        def given(least: int) -> Iterator[pa.RecordBatch]:
            if len(rows) > least:
                names = [x.split(" ")[0] for x in PIECES.split(", ")]
                kinds = [*[pa.int64()] * 8, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                rows.clear()

        for batch in batches:
            for part in slices(batch, "__text", STEP):
                for doc, found in zip(part.column(0).to_pylist(), words.many(part.column(1).to_pylist()), strict=True):
                    ids = np.concatenate([found, end])
                    cut = len(ids) - len(ids) % window
                    for start in range(0, cut, window):
                        piece(doc, start, len(ids), ids[start : start + window], 0, window)
                        sequence += 1
                    if cut < len(ids):
                        pool.append((doc, cut, len(ids), ids[cut:].copy()))
                        held += len(ids) - cut
                    if held >= pool_tokens:
                        flush()
                yield from given(20_000)
        flush()
        yield from given(0)
        words.forget()

    ship(docs.sparkSession)
    read = docs.select(F.col(id_column).cast("long").alias("__id"), F.col(text_column).alias("__text"))
    return read.mapInArrow(pack, PIECES)
