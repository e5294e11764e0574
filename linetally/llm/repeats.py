"""Dedup of repeated passages over a sparse, distributed suffix array.

Each byte covered by a 50-byte string that also starts in a document with a smaller id is removed. All matches are
found, with few suffixes: in every window of 50 bytes the leftmost 8-byte word with the smallest hash is its anchor, so
equal windows have their anchor at the same place, and only the suffixes at anchors are sorted (about one in 22).

1. A task cuts its texts' anchors out with what lies around them (42 bytes before, 50 from the anchor on), sorts them by
   the suffix, and folds equal surroundings: only the smallest document of each needs to travel, the others are
   covered already.
2. Sorted runs are exchanged by ranges of suffixes (range bounds from a sample of documents), front-coded: each suffix
   is written as the length it shares with the one before and the rest.
3. Each range merges its runs with a loser tree that carries common-prefix lengths: two suffixes are compared by how
   much they share with the last one given out, and bytes are looked at only beyond that, so no known prefix is read
   twice. The merged order comes with the common prefix of neighbours, that is, a suffix array with its LCP array.
4. For every place an anchor can have in a window, documents that agree on enough bytes after the anchor (an interval of
   the LCP array) and before it (the same over the reversed bytes) form a class, and all but its smallest document are
   covered there. Covered stretches go back to their documents, are joined, and the kept bytes are hashed.

Null text counts as empty. Null ids are below all others. Rows with the same id do not cover each other; rows that
repeat in full get the same result. Texts under 50 bytes lose nothing. An empty table gives an empty result. Other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetally.env import written
from linetally.llm.common import hash_63, last_drawn, lean, ship, sized_join, slices, utf8, whole_text
from linetally.llm.words import mixed

WINDOW = 50
WORD = 8
BEFORE = WINDOW - WORD  # an anchor has up to so many bytes of its window before it
#: Suffixes that a range should have.
RANGE_ROWS = 300_000
#: Texts that a task cuts and sorts together, in bytes.
RUN_BYTES = 10 << 20
#: Documents sampled for the range bounds, and bounds taken from each.
SAMPLED_DOCS = 4_000
#: Documents with removed bytes that are broadcast at most.
MOST_COVERED = 500_000
NO_ID = -(1 << 63)


def anchors(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places of all windows' anchors in the bytes of texts that begin at ``at``."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    found = []
    step = 1 << 23
    for a in range(0, n - WINDOW + 1, step):  # parts share a window less one byte
        part = np.ascontiguousarray(data[a : a + step + WINDOW - 1])
        m = len(part) - WORD + 1
        words = np.ndarray((m,), "<u8", part, strides=(1,))
        x = mixed(words) & np.uint64(0xFFFFFFFFFF000000) | np.arange(m, dtype=np.uint64)  # leftmost of equals
        for shift in (1, 2, 4, 8, 16):
            x = np.minimum(x[:-shift], x[shift:])
        rest = BEFORE + 1 - 32
        x = np.minimum(x[: len(x) - rest], x[rest:])
        starts = np.arange(a, a + len(x))
        # windows that run over their text's end are none
        ends = np.repeat(at[1:], np.diff(at))[a : a + len(x)]
        good = starts + WINDOW <= ends
        place = (x[good] & np.uint64(0xFFFFFF)).astype(np.int64) + a
        found.append(place[np.diff(place, prepend=-1) != 0])
    return np.unique(np.concatenate(found))


def surroundings(data: np.ndarray, at: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each anchor: 50 bytes from it on, 42 before it backwards (zeros outside the text), and how many are real."""
    doc = np.searchsorted(at, place, "right") - 1
    after = np.minimum(at[doc + 1] - place, WINDOW)
    before = np.minimum(place - at[doc], BEFORE)
    padded = np.concatenate([np.zeros(BEFORE, np.uint8), data, np.zeros(WINDOW, np.uint8)])
    right = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[place + BEFORE].copy()
    left = np.lib.stride_tricks.sliding_window_view(padded, BEFORE)[place][:, ::-1].copy()
    right[np.arange(WINDOW) >= after[:, None]] = 0
    left[np.arange(BEFORE) >= before[:, None]] = 0
    return doc, right, left, after.astype(np.uint8), before.astype(np.uint8)


def text_order(*parts: np.ndarray) -> np.ndarray:
    """Order of byte rows of equal width, given in parts from the left."""
    wide = np.zeros((len(parts[0]), -(-sum(p.shape[1] for p in parts) // 8) * 8), np.uint8)
    at = 0
    for p in parts:
        wide[:, at : at + p.shape[1]] = p
        at += p.shape[1]
    columns = wide.view(">u8").astype(np.uint64)
    del wide
    order = np.argsort(columns[:, 0], kind="stable")
    # only rows that agree so far are ordered by the next eight bytes
    for c in range(1, columns.shape[1]):
        same = np.concatenate([[False], (columns[order[1:], :c] == columns[order[:-1], :c]).all(1)])
        tied = same | np.concatenate([same[1:], [False]])
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group = np.cumsum(~same)[at]
        sub = order[at]
        order[at] = sub[np.lexsort((columns[sub, c], group))]
    return order


def shared(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row of a sorted run has in common with the row before."""
    out = np.zeros(len(rows), np.uint8)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def _packed(*parts: bytes) -> bytes:
    body = b"".join([struct.pack("<B", len(parts)), *(struct.pack("<Q", len(p)) for p in parts), *parts])
    return zstandard.compress(body, 1)


def _unpacked(data: bytes) -> list[bytes]:
    body = zstandard.decompress(data)
    sizes = struct.unpack_from(f"<{body[0]}Q", body, 1)
    at, out = 1 + 8 * len(sizes), []
    for n in sizes:
        out.append(body[at : at + n])
        at += n
    return out


def _frame(right, left, after, before, doc, place, docs, done) -> bytes:
    """A front-coded run: suffixes in order, with their documents; ``done``: (doc, start, end) covered already."""
    common = shared(right)
    tails = right[np.arange(WINDOW) >= common[:, None]]
    used, number = np.unique(np.concatenate([doc, done[:, 0]]), return_inverse=True)
    back = np.column_stack([number[len(doc) :], done[:, 1:]])
    return _packed(
        common.tobytes(), tails.tobytes(), left.tobytes(), after.tobytes(), before.tobytes(), number[: len(doc)].astype("<u4").tobytes(),
        place.astype("<i8").tobytes(), docs[used, 0].astype("<i8").tobytes(), docs[used, 1].astype("<u4").tobytes(), back.astype("<i8").tobytes(),
    )


def _read_frame(data: bytes) -> tuple:
    common, tails, left, after, before, number, place, ids, hashes, back = _unpacked(data)
    docs = np.column_stack([np.frombuffer(ids, "<i8"), np.frombuffer(hashes, "<u4").astype(np.int64)])
    common = np.frombuffer(common, np.uint8)
    size = WINDOW - common.astype(np.int64)
    tail, at, last, strings = tails, 0, b"", []
    for c, n in zip(common.tolist(), size.tolist(), strict=True):
        last = last[:c] + tail[at : at + n]
        strings.append(last)
        at += n
    return (
        strings, common.tolist(), np.frombuffer(left, np.uint8).reshape(-1, BEFORE), np.frombuffer(after, np.uint8), np.frombuffer(before, np.uint8),
        np.frombuffer(number, "<u4"), np.frombuffer(place, "<i8"), docs, np.frombuffer(back, "<i8").reshape(-1, 3),
    )


def merge_runs(strings: list[list[bytes]], common: list[list[int]]) -> tuple[list[int], list[int]]:
    """Merge sorted runs of equally long strings with a loser tree that carries common-prefix lengths.

    ``common``: for each string what it shares with the one before in its run. Returns the runs in the order their next
    strings are given out, and for each string given out what it shares with the one before.
    """
    runs = [i for i, s in enumerate(strings) if s]
    size = 1
    while size < len(runs):
        size *= 2
    head = [strings[r][0] for r in runs] + [None] * (size - len(runs))  # None: used up, loses to all
    known = [0] * size  # bytes each head shares with the last string given out
    at = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = head[a], head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        k, m = known[a], known[b]
        if k > m:
            return a, b
        if k < m:
            return b, a
        if x == y:
            known[b] = len(x)
            return a, b
        while x[k] == y[k]:
            k += 1
        if x[k] < y[k]:
            known[b] = k
            return a, b
        known[a] = k
        return b, a

    loser = [0] * size
    winners = list(range(size))
    level = size
    while level > 1:
        level //= 2
        after = []
        for j in range(level):
            w, lost = play(winners[2 * j], winners[2 * j + 1])
            loser[level + j] = lost
            after.append(w)
        winners = after
    w = winners[0]
    order, out = [], []
    total = sum(map(len, strings))
    give, share = order.append, out.append
    for _ in range(total):
        give(runs[w])
        share(known[w])
        at[w] += 1
        run = strings[runs[w]]
        if at[w] < len(run):
            head[w] = run[at[w]]
            known[w] = common[runs[w]][at[w]]
        else:
            head[w] = None
        node = (w + size) >> 1
        while node:
            other = loser[node]
            y = head[other]
            if y is not None:
                x, k, m = head[w], known[w], known[other]
                if x is None or k < m:
                    loser[node], w = w, other
                elif k == m:
                    if x == y:
                        known[other] = len(x)
                    else:
                        while x[k] == y[k]:
                            k += 1
                        if x[k] < y[k]:
                            known[other] = k
                        else:
                            known[w] = k
                            loser[node], w = w, other
            node >>= 1
    return order, out


def _classes(common: np.ndarray, depth: int) -> np.ndarray:
    """Numbers of the classes of sorted rows that agree on ``depth`` bytes."""
    return np.cumsum(common < depth)


def covered(right_common: np.ndarray, left: np.ndarray, after: np.ndarray, before: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (sorted by suffix) covered by a smaller owner, with the first and last number of bytes before the anchor
    at which a covered window begins."""
    n = len(owner)
    low, high = np.full(n, WINDOW, np.int64), np.full(n, -1, np.int64)
    middle = WINDOW // 2
    top = np.maximum(right_common, np.append(right_common[1:], 0))
    deep = np.zeros(n, np.uint64)  # bytes before the anchor, to the middle
    for j in range(middle):
        deep = deep * np.uint64(0x100000001B3) + left[:, j]
    eight = _classes(right_common, WORD).astype(np.uint64)
    pair = mixed(mixed(deep) + eight * np.uint64(0x9E3779B97F4A7C15))
    _, back, count = np.unique(pair, return_inverse=True, return_counts=True)
    sets = (
        (np.flatnonzero(top >= WINDOW - middle), range(0, middle)),  # much agrees after the anchor
        (np.flatnonzero((count[back] > 1) & (before >= middle)), range(middle, BEFORE + 1)),  # or before it
    )
    for rows, places in sets:
        if len(rows) < 2:
            continue
        order = text_order(left[rows])
        left_common = shared(left[rows][order])
        own, aft, bef = owner[rows], after[rows], before[rows]
        # what neighbours among the chosen rows share is the least between them in the whole order
        kept = np.minimum.reduceat(right_common[: rows[-1] + 1], np.concatenate([[0], rows[:-1] + 1]))
        kept[0] = 0
        for o in places:
            good = np.flatnonzero((aft >= WINDOW - o) & (bef >= o))
            if len(good) < 2:
                continue
            by_left = np.empty(len(rows), np.int64)
            by_left[order] = _classes(left_common, o) if o else 0
            key = (_classes(kept, WINDOW - o) * (len(rows) + 1) + by_left)[good]
            by = np.lexsort((own[good], key))
            first = np.flatnonzero(np.diff(key[by], prepend=-1))
            least = np.repeat(own[good][by][first], np.diff(np.append(first, len(by))))
            hit = rows[good[by[least < own[good][by]]]]
            low[hit] = np.minimum(low[hit], o)
            high[hit] = np.maximum(high[hit], o)
    rows = np.flatnonzero(high >= 0)
    return rows, low[rows], high[rows]


def _runs(docs: DataFrame, bounds: list[bytes]) -> DataFrame:
    """Front-coded runs by range: columns ``part`` (range) and ``frame``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def given() -> Iterator[pa.RecordBatch]:
            nonlocal size
            docs_, doc, right, left, after, before, place = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            size = 0
            order = text_order(right, left)
            doc, right, left, after, before, place = (x[order] for x in (doc, right, left, after, before, place))
            # equal surroundings: the smallest id stays, others are covered by it
            same = np.concatenate([[False], (right[1:] == right[:-1]).all(1) & (left[1:] == left[:-1]).all(1) & (after[1:] == after[:-1]) & (before[1:] == before[:-1])])
            group = np.cumsum(~same) - 1
            ids = docs_[doc, 0]
            by = np.lexsort((ids, group))
            first = np.flatnonzero(np.diff(group[by], prepend=-1))
            keeper = np.repeat(by[first], np.diff(np.append(first, len(by))))
            lost = by[(ids[by] > ids[keeper])]
            stays = np.ones(len(doc), bool)
            stays[lost] = False
            most = np.minimum(before, BEFORE).astype(np.int64)
            least = np.maximum(0, WINDOW - after.astype(np.int64))
            done = np.column_stack([doc, place - most, place - least + WINDOW])[lost]
            part_of = np.zeros(len(doc), np.int64)
            at = 0
            for k, b in enumerate(bounds):
                # first row not below the bound
                lo, hi = at, len(doc)
                while lo < hi:
                    mid = (lo + hi) // 2
                    if right[mid].tobytes() < b:
                        lo = mid + 1
                    else:
                        hi = mid
                part_of[lo:] = k + 1
                at = lo
            for k in np.unique(part_of):
                rows = np.flatnonzero((part_of == k) & stays)
                back = done[part_of[lost] == k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(k)], pa.int32()), pa.array([_frame(right[rows], left[rows], after[rows], before[rows], doc[rows], place[rows], docs_, back)], pa.binary())],
                    ["part", "frame"],
                )

        number = 0
        for batch in batches:
            for part in slices(batch, "text", RUN_BYTES // 4):
                data, at = utf8(part.column(2))
                place = anchors(data, at)
                doc, right, left, after, before = surroundings(data, at, place)
                ids = np.stack([part.column(0).fill_null(NO_ID).to_numpy(), part.column(1).to_numpy()], 1)
                if not held:
                    number = 0
                held.append((ids, doc + number, right, left, after, before, place - at[doc]))
                number += part.num_rows
                size += len(data)
                if size >= RUN_BYTES:
                    yield from given()
        if held:
            yield from given()

    return docs.mapInArrow(cut, "part int, frame binary")


def _buckets(ids: np.ndarray, count: int) -> np.ndarray:
    return (mixed(ids[:, 0].astype(np.uint64) ^ mixed(ids[:, 1].astype(np.uint64))) % np.uint64(count)).astype(np.int64)


def _merged(runs: DataFrame, buckets: int) -> DataFrame:
    """Covered stretches of all documents, packed by bucket of documents."""

    def merge(frames: pd.DataFrame) -> pd.DataFrame:
        lean()
        read = [_read_frame(f) for f in frames["frame"]]
        docs = np.concatenate([r[7] for r in read])
        shift = np.cumsum([0, *(len(r[7]) for r in read)])[:-1]
        done = np.concatenate([r[8] + np.array([s, 0, 0]) for r, s in zip(read, shift, strict=True)])
        order, common = merge_runs([r[0] for r in read], [r[1] for r in read])
        order = np.array(order, np.int64)
        # the k-th time a run is named, its k-th row is meant
        rows = np.empty(len(order), np.int64)
        rows[np.argsort(order, kind="stable")] = np.arange(len(order))
        left, after, before, place = (np.concatenate([r[i] for r in read])[rows] for i in (2, 3, 4, 6))
        number = np.concatenate([r[5].astype(np.int64) + s for r, s in zip(read, shift, strict=True)])[rows]
        del read
        hit, low, high = covered(np.array(common, np.int64), left, after, before, docs[number, 0])
        found = np.column_stack([number[hit], place[hit] - high, place[hit] - low + WINDOW])
        found = np.concatenate([done, found]).astype(np.int64)
        if not len(found):
            return pd.DataFrame({"bucket": [], "frame": []})
        of = _buckets(docs[found[:, 0]], buckets)
        out = []
        for b in np.unique(of):
            some = found[of == b]
            used, n = np.unique(some[:, 0], return_inverse=True)
            out.append((int(b), _packed(docs[used].astype("<i8").tobytes(), n.astype("<u4").tobytes(), some[:, 1:].astype("<i8").tobytes())))
        return pd.DataFrame(out, columns=["bucket", "frame"])

    return runs.groupBy("part").applyInPandas(merge, "bucket int, frame binary")


def _joined(stretches: DataFrame) -> DataFrame:
    """One row per document (id, hash of the text) with its covered stretches: sorted, apart, as pairs of i64."""

    def join(frames: pd.DataFrame) -> pd.DataFrame:
        keys, spans = [], []
        for f in frames["frame"]:
            docs, number, some = _unpacked(f)
            keys.append(np.frombuffer(docs, "<i8").reshape(-1, 2)[np.frombuffer(number, "<u4")])
            spans.append(np.frombuffer(some, "<i8").reshape(-1, 2))
        key, span = np.concatenate(keys), np.concatenate(spans)
        order = np.lexsort((span[:, 0], key[:, 1], key[:, 0]))
        key, span = key[order], span[order]
        new_doc = np.concatenate([[True], (key[1:] != key[:-1]).any(1)])
        # ends grow within a document: a running maximum over end and number of the document
        doc = np.cumsum(new_doc) - 1
        reach = np.maximum.accumulate(span[:, 1] + doc * (1 << 40)) - doc * (1 << 40)
        opens = new_doc | np.concatenate([[True], span[1:, 0] > reach[:-1]])
        starts = span[opens, 0]
        last = np.append(np.flatnonzero(opens)[1:], len(span)) - 1
        pairs = np.stack([starts, reach[last]], 1).astype("<i8")
        of = doc[opens]
        cuts = np.searchsorted(of, np.arange(doc[-1] + 2))
        head = np.flatnonzero(new_doc)
        return pd.DataFrame({"id": key[head, 0], "hash": key[head, 1], "spans": [pairs[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]})

    return stretches.groupBy("bucket").applyInPandas(join, "id long, hash long, spans binary")


def _bounds(docs: DataFrame, rows: int, ranges: int) -> list[bytes]:
    """Range bounds from the suffixes of a sample of documents (by hash)."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                data, at = utf8(part.column(2))
                place = anchors(data, at)
                step = max(1, len(place) * len(place) // 20_000_000)  # a long text does not decide alone
                _, right, *_ = surroundings(data, at, place[::step])
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()[:24] for r in right], pa.binary())], ["s"])

    picked = docs.where(hash_63("doc_id", "hash") <= F.lit(last_drawn(SAMPLED_DOCS, rows)))
    some = picked.mapInArrow(look, "s binary").where(F.rand(1) < min(1.0, 200_000 / (SAMPLED_DOCS * 170))).toPandas()["s"]
    found = sorted(map(bytes, some))
    return sorted({found[i * len(found) // ranges] for i in range(1, ranges)}) if found else []


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", range_rows: int = RANGE_ROWS, with_kept: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and (``with_kept``) the bytes kept and the
    removed stretches (pairs of little-endian 64-bit numbers, first and last plus one)."""
    spark = docs.sparkSession
    ship(spark)
    text = whole_text(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)).alias("hash"), text.alias("text"))
    count, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    ranges = max(1, int(size / 22 / range_rows) + 1)
    bounds = _bounds(rows, count, ranges)
    stretches = _merged(_runs(rows, bounds), max(1, int(count // 20_000) + 1))
    found = written(_joined(stretches), "repeats")
    found = found.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("id"), F.col("hash").alias("found_hash"), "spans")
    on = rows["doc_id"].eqNullSafe(found["id"]) & (rows["hash"] == found["found_hash"])
    joined = sized_join(rows, found, on, "left", found.count(), MOST_COVERED).select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, removed binary"

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                data, at = utf8(part.column(1))
                whole, out = data.tobytes(), []
                for i, spans in enumerate(part.column(2).to_pylist()):
                    a, b = int(at[i]), int(at[i + 1])
                    pairs = np.frombuffer(spans or b"", "<i8").reshape(-1, 2)
                    edges = [a, *(pairs + a).ravel().tolist(), b]
                    kept = b"".join(whole[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                    out.append((b - a, b - a - len(kept), len(pairs), hashlib.sha256(kept).hexdigest(), kept if with_kept else None, spans if with_kept else None))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
                names = [x.split(" ")[0] for x in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], names)

    return joined.mapInArrow(keep, schema)
