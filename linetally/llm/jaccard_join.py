"""Exact n-gram Jaccard self-join by partitioning the universe of shingles, and its connected components.

A document is the set of its 5-word shingles (64-bit hashes). Two sets with a similarity of 3/4 or more share all but a
quarter of each. The join finds every such pair, as a pigeonhole:

* **Segments.** The universe is cut by hash into segments, as finely as it can be: one for each value. Coarser segments
  would be broken by shingles of either side, so twice as many had to be indexed, and fewer could be left out. Of a set's
  N segments a partner misses N / 4 at most, so N - N / 4 are shared.
* **Cost-based allocation.** All sets order their segments alike, the most frequent first, and leave out the first ones.
  What is shared comes in the same order on both sides, so those left out cost a pair no more than the longer of the two
  lists: a set may leave out all but N / 4 + 1 of its segments, and each that it puts in beyond that has to be shared, too.
  What is frequent is read from a count of all shingles in a fixed sketch, so a common passage is not indexed unless a
  set has little else.
* **Places.** An entry carries its place among its set's segments, the rarest being 0. A linked pair of sizes r and s shares
  o = 3 (r + s) / 7 or more, so its k rarest common entries stand within the first r - o + k places of one side and s - o + k
  of the other. Meetings further back are not put out: of two sets of one size that is a seventh, where a set indexes
  a quarter, and what the members of a family of similar texts have apart is rarer than what they share.
* **Size bands.** How many segments a set puts in beyond the least is settled by its band (bands grow by 4/3, so that
  partners lie in the same or in neighbouring ones).
* **Parities.** Each set has a bitmap of 256 parities: a shingle flips the bit it hashes to. Bitmaps of two sets differ in
  no more bits than the sets have shingles apart, so a pair whose bitmaps differ in more than (r + s) / 7 is no link. It
  is dropped where it is found, before it is put out. No link is lost: it is a bound, not an estimate. Bitmaps of larger
  sets, which would be full, do not travel with the index.
* **Counting.** Pairs that share fewer index entries than they must are dropped; the others are verified on the texts.
* **Rounds.** Of the pairs that lead from one component to another a few are verified first, those that share the most
  entries. Links found join components, and pairs inside one go. Each round verifies eight times as many of two
  components' pairs, until none is left. So a set that meets all of a large group is not verified with each of its sets,
  and no two components stay apart without all their pairs being verified.

Equal sets are one class throughout and joined as one. Large groups of near copies are not expanded: sets are first
compared with one set that has the same minimum hash, and links found so make components. Three rounds with other hash
functions and other pivots leave few near copies apart. The index then only yields pairs of different components, as a
pair inside one would add nothing. Index
entries travel packed, as rows of a few thousand sets for a bucket of the index.

Null, empty and blank texts have empty sets, are linked with nothing, and are their own component. With one to four
words the whole sequence is the only shingle. Null ids are handled as the smallest; ids that repeat are one vertex. An
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetally.env import forget, written
from linetally.llm.common import fresh, lean, ship, sized_join, slices
from linetally.llm.components import components
from linetally.llm.words import Words, mixed, word_bytes

SHINGLE = 5
STEP = 2 << 20
#: Cells of the sketch that counts shingles: 16 MB.
SKETCH = 1 << 22
PIVOT_ROUNDS = ((0, 1, 2), (3, 4, 5, 6, 7), (8, 9, 10, 11, 12, 13, 14, 15))
PIVOT_HASHES = 16
#: Pairs of two components that are verified first, and how many times as many each round after that.
FIRST_PAIRS, MORE_PAIRS = 2, 8
#: Words of 64 parities that a set's bitmap has.
PARITY_WORDS = 4
#: Entries of the index that a bucket should have.
BUCKET_ROWS = 1_200_000
#: Rows (a few numbers each) that are broadcast at most.
MOST_ROWS = 500_000
#: Shingles of a band's smallest set for each entry that its sets put in beyond the least.
MORE = 32
#: Shingles up to which a set's bitmap goes with its index entries.
PARITY_SETS = 192
NO_ID = -(1 << 63)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending, one text after another, and the offsets of the texts."""
    words = Words.of(column, word_bytes("solid"))
    n = len(words.first) - 1
    count = np.diff(words.first)
    h = words.hashes()
    place = np.arange(len(h)) - words.first[words.doc] if len(h) else np.zeros(0, np.int64)
    runs = np.where(count[words.doc] >= SHINGLE, place <= count[words.doc] - SHINGLE, place == 0) if len(h) else np.zeros(0, bool)
    value = np.zeros(len(h), np.uint64)
    for i in range(SHINGLE):
        there = i < np.minimum(count[words.doc] - place, SHINGLE)
        here = np.zeros(len(h), np.uint64)
        here[: len(h) - i] = h[i:]
        value = np.where(there, mixed(value * np.uint64(0x9E3779B97F4A7C15) + here + np.uint64(i + 1)), value)
    value, doc = value[runs], words.doc[runs]
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, np.searchsorted(doc, np.arange(n + 1))


def parities(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A bitmap for each set, of the parities of its shingles by hash: one row of 64-bit words a set."""
    out = np.zeros((len(at) - 1, PARITY_WORDS), np.uint64)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        h = mixed(values + np.uint64(0x51ED))
        bit, word = np.uint64(1) << (h & np.uint64(63)), (h >> np.uint64(6)) % np.uint64(PARITY_WORDS)
        for k in range(PARITY_WORDS):
            out[some, k] = np.bitwise_xor.reduceat(np.where(word == np.uint64(k), bit, np.uint64(0)), at[some])
    return out


def bands(most: int = 1 << 40) -> np.ndarray:
    """First size of each band: partners of a band's sets lie in it or next to it."""
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, 4 * (out[-1] - 1) // 3 + 1))
    return np.array(out, np.int64)


_BANDS = bands()


def index_entries(values: np.ndarray, at: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, ...]:
    """Index entries of many sets.

    Returns the entries (64-bit; each set's together, its rarest last) with the number of the member each is of, and the members: set, band, whether it is
    looked up against all others (here each is), slack (entries shared with a partner before any are left out), entries
    left out.
    """
    size = np.diff(at)
    sets = np.flatnonzero(size >= 3)  # below, only equal sets link
    own = size[sets]
    band = np.searchsorted(_BANDS, own, "right") - 1
    slack = own - own // 4
    left_out = np.maximum(0, slack - 1 - _BANDS[band] // MORE)
    begin = np.concatenate([[0], np.cumsum(own)])
    rows = np.repeat(np.arange(len(sets)), own)
    v = values[np.arange(len(rows)) + (at[sets] - begin[:-1])[rows]]
    often = sketch[(v >> np.uint64(42)).astype(np.int64)].astype(np.int64)
    # the most frequent first, then by value: a text's values ascend already
    order = np.argsort((rows << 32) - often, kind="stable")
    kept = order[np.arange(len(rows)) - begin[rows] >= left_out[rows]]
    members = np.column_stack([sets, band, np.ones(len(sets), np.int64), slack, left_out])
    return mixed(v[kept]), rows[kept], members.astype(np.int64)


def places(owner: np.ndarray) -> np.ndarray:
    """The place of each entry of ``index_entries`` among its set's segments; 0 is the rarest."""
    return np.searchsorted(owner, owner, "right") - 1 - np.arange(len(owner))


def pairs_of(
    keys: np.ndarray, owner: np.ndarray, component: np.ndarray, size: np.ndarray, looked_up: np.ndarray, parity: np.ndarray | None = None, parity_sets: int = 1 << 40,
    place: np.ndarray | None = None, shared: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members with a common key, as (first, second), and how many keys they have in common.

    Left out: pairs of one component, of sizes too far apart, of two members neither of which is looked up, and of
    parities (where given, for sets of up to ``parity_sets``) that differ in more bits than linked sets can. With the
    ``place`` of each entry (0: the rarest of its set) and what each member has to share (``shared``), only meetings count
    that can be among the rarest ones of a linked pair.
    """
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    place = None if place is None else place[order]
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    count = np.diff(np.append(begin, len(keys)))
    begin, count = begin[count > 1], count[count > 1]
    found: list[np.ndarray] = []
    n = len(component)

    def add(at_a: np.ndarray, at_b: np.ndarray) -> None:
        a, b = owner[at_a], owner[at_b]
        lo, hi = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
        good = (component[a] != component[b]) & (4 * lo >= 3 * hi) & (looked_up[a] | looked_up[b]).astype(bool) & (a != b)
        if place is not None:
            # places that the rarest common entries cannot have: beyond all that one side may have apart
            beyond = np.minimum(shared[a], shared[b]) - (3 * (lo + hi) + 6) // 7
            good &= (place[at_a] < size[a] + beyond) & (place[at_b] < size[b] + beyond)
        a, b = a[good], b[good]
        if parity is not None:
            apart = np.bitwise_count(parity[a] ^ parity[b]).sum(axis=1, dtype=np.int64)
            near = (7 * apart <= size[a] + size[b]) | (np.maximum(size[a], size[b]) > parity_sets)
            a, b = a[near], b[near]
        found.append(np.minimum(a, b) * n + np.maximum(a, b))

    for g in np.unique(count):
        rows = begin[count == g]
        if g <= 64:
            for r in range(0, len(rows), max(1, 500_000 // int(g * g))):
                grid = rows[r : r + max(1, 500_000 // int(g * g)), None] + np.arange(g)
                i, j = np.triu_indices(int(g), 1)
                add(grid[:, i].ravel(), grid[:, j].ravel())
        else:
            for r in rows:  # all of one component in a row: nothing to do
                group = component[owner[r : r + g]]
                if (group == group[0]).all():
                    continue
                for k in range(r, r + g - 1):
                    add(np.full(r + g - k - 1, k), np.arange(k + 1, r + g))
        if sum(map(len, found)) > 5_000_000:
            found = [np.sort(np.concatenate(found))]
    every = np.concatenate(found) if found else np.zeros(0, np.int64)
    pair, times = np.unique(every, return_counts=True)
    return np.column_stack([pair // max(n, 1), pair % max(n, 1)]), times


def _entries(docs: DataFrame, sketch, buckets: int) -> DataFrame:
    """``docs``: id, component, text. Packed index entries by bucket."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(sketch.value, np.uint32)
        for batch in batches:
            for part in slices(batch, "text", STEP):
                values, at = shingle_sets(part.column(2))
                keys, owner, members = index_entries(values, at, table)
                parity = parities(values, at)
                ids, parts = part.column(0).to_numpy(), part.column(1).to_numpy()
                size = np.diff(at)
                place = np.minimum(places(owner), 0xFFFF)
                bucket = (keys % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((keys, bucket))
                keys, owner, place, bucket = keys[order], owner[order], place[order], bucket[order]
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-2)) if len(bucket) else []
                out = []
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    used, number = np.unique(owner[a:b], return_inverse=True)
                    m = members[used]
                    # 40 bits of a key, besides the bucket: chance meetings are sorted out by verifying
                    short = (keys[a:b] >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                    kind = "<u2" if len(used) <= 1 << 16 else "<u4"
                    body = b"".join([
                        struct.pack("<QQ", b - a, len(used)), np.ascontiguousarray(short.T).tobytes(), number.astype(kind).tobytes(),
                        np.ascontiguousarray(place[a:b].astype("<u2").view(np.uint8).reshape(-1, 2).T).tobytes(),
                        # most sets are their own component, and ids of a part lie close together: small numbers compress
                        np.column_stack([np.diff(ids[m[:, 0]], prepend=0), parts[m[:, 0]] ^ ids[m[:, 0]], size[m[:, 0]], m[:, 3] - m[:, 4]]).astype("<i8").T.tobytes(),
                        parity[m[size[m[:, 0]] <= PARITY_SETS, 0]].astype("<u8").tobytes(),
                    ])
                    out.append((int(bucket[a]), zstandard.compress(body, 1)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["bucket", "frame"])

    return docs.mapInArrow(cut, "bucket int, frame binary")


def _candidates(entries: DataFrame) -> DataFrame:
    """Pairs that share enough index entries: a, b (ids), n (entries shared), from, to (their components, the smaller first)."""

    def join(frames: pd.DataFrame) -> pd.DataFrame:
        lean()
        keys, owners, places_, members, parity, shift = [], [], [], [], [], 0
        for f in frames["frame"]:
            body = zstandard.decompress(f)
            n, m = struct.unpack_from("<QQ", body)
            raw = np.zeros((n, 8), np.uint8)
            raw[:, :5] = np.frombuffer(body, np.uint8, 5 * n, 16).reshape(5, n).T
            keys.append(raw.view("<u8").ravel())
            kind = np.dtype("<u2" if m <= 1 << 16 else "<u4")
            owners.append(np.frombuffer(body, kind, n, 16 + 5 * n).astype(np.int64) + shift)
            rest = 16 + 5 * n + kind.itemsize * n
            places_.append(np.ascontiguousarray(np.frombuffer(body, np.uint8, 2 * n, rest).reshape(2, n).T).view("<u2").ravel())
            rest += 2 * n
            own = np.frombuffer(body, "<i8", 4 * m, rest).reshape(4, m).copy()
            own[0] = np.cumsum(own[0])
            own[1] ^= own[0]
            members.append(own)
            bits = np.zeros((m, PARITY_WORDS), np.uint64)
            bits[own[2] <= PARITY_SETS] = np.frombuffer(body, "<u8", -1, rest + 32 * m).reshape(-1, PARITY_WORDS)
            parity.append(bits)
            shift += m
        ids, component, size, shared = np.concatenate(members, axis=1)
        place = np.concatenate(places_).astype(np.int64)
        pair, times = pairs_of(np.concatenate(keys), np.concatenate(owners), component, size, np.ones(shift, bool), np.concatenate(parity), PARITY_SETS, place, shared)
        a, b = pair[:, 0], pair[:, 1]
        # of the slack of the one with more, at most the longer of the two lists is lost
        need = np.minimum(shared[a], shared[b])
        low, high = np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])
        good = low < high
        ends = np.minimum(component[a], component[b]), np.maximum(component[a], component[b])
        return pd.DataFrame({"a": low[good], "b": high[good], "n": times[good], "need": need[good], "from": ends[0][good], "to": ends[1][good]})

    met = entries.groupBy("bucket").applyInPandas(join, "a long, b long, n long, need long, from long, to long")
    summed = met.groupBy("a", "b").agg(F.sum("n").alias("n"), *[F.min(c).alias(c) for c in ("need", "from", "to")])
    return summed.where("n >= need").drop("need")


def _verified(pairs: DataFrame, rows: DataFrame, links: DataFrame, found: DataFrame, kept: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Links and components with the pairs of ``_candidates`` taken in. Every pair is verified unless links join its ends first.

    ``links``, ``found``: those known before, which the components of the pairs come from.
    """
    tries, left, texts = FIRST_PAIRS, pairs.count(), _texts_of(rows, pairs, kept)
    while left:
        # the pairs of two components are dealt into bins, and the best of each is taken: no group of pairs meets in a task
        best = F.max(F.struct("n", "a", "b")).alias("best")
        some = kept(pairs.groupBy("from", "to", F.pmod(F.xxhash64("a", "b"), F.lit(tries)).alias("bin")).agg(best).select("best.a", "best.b"), "join-tried")
        tried = some.count()
        last = left <= 2 * tried
        some = pairs.select("a", "b") if last else some
        new = kept(_linked(some, texts if last else _texts_of(texts, some, kept)), "join-more-links")
        links = kept(links.unionByName(new), "join-links")
        found = kept(components(links), "join-found")
        if last:
            break
        label = found.withColumnRenamed("v", "id")
        for end in ("from", "to"):
            moved = label.select(F.col("id").alias(end), "label")
            pairs = pairs.join(moved, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
        ends = F.least("from", "to").alias("from"), F.greatest("from", "to").alias("to")
        pairs = pairs.where(F.col("from") != F.col("to")).join(some, ["a", "b"], "left_anti").select("a", "b", "n", *ends)
        pairs = kept(pairs, "join-pairs")
        texts = _texts_of(texts, pairs, kept)
        tries, left = tries * MORE_PAIRS, pairs.count()
    return links, found


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. ``sets``: id, text."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text_b", STEP):
                va, at_a = shingle_sets(some.column(2))
                vb, at_b = shingle_sets(some.column(3))
                n = some.num_rows
                own = np.concatenate([np.repeat(np.arange(n), np.diff(at_a)), np.repeat(np.arange(n), np.diff(at_b))])
                v = np.concatenate([va, vb])
                order = np.lexsort((v, own))
                v, own = v[order], own[order]
                common = np.bincount(own[1:][(v[1:] == v[:-1]) & (own[1:] == own[:-1])], minlength=n)
                union = np.diff(at_a) + np.diff(at_b) - common
                good = (100 * common >= 75 * union) & (union > 0)
                yield pa.RecordBatch.from_arrays([some.column(0).filter(pa.array(good)), some.column(1).filter(pa.array(good))], ["a", "b"])

    first = sets.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    second = sets.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long")


def _texts_of(rows: DataFrame, pairs: DataFrame, kept: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """id and text of the documents in the pairs, written once."""
    ids = kept(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "join-ids")
    return kept(sized_join(rows.select("id", "text"), ids, "id", "left_semi", ids.count(), MOST_ROWS), "join-texts")


def similar(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links), class_id (smallest id
    with the same set), n_links (sets of other classes it was found linked to; a lower bound inside a component)."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_column).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = [np.uint64(0xA5A5A5A5 + 7919 * i) for i in range(PIVOT_HASHES)]
        for batch in batches:
            for part in slices(batch, "text", STEP):
                values, at = shingle_sets(part.column(1))
                size = np.diff(at)
                some = np.flatnonzero(size)
                data = values.tobytes()
                keys: list[bytes | None] = [None] * len(size)
                for i in some.tolist():
                    keys[i] = xxhash.xxh3_128_digest(data[8 * at[i] : 8 * at[i + 1]])
                least = np.zeros((PIVOT_HASHES, len(size)), np.int64)
                for k, salt in enumerate(salts):
                    if len(some):
                        least[k, some] = np.minimum.reduceat(mixed(values + salt), at[some]).view(np.int64)
                lists = [
                    pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(x).ravel()), x.shape[1]).cast(pa.list_(pa.int64()))
                    for x in (least.T, parities(values, at).view(np.int64))
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size, pa.int64()), pa.array(keys, pa.binary()), *lists], ["id", "n", "key", "least", "parity"])

    scratch: list[DataFrame] = []  # tables that the result does not read any more: removed at the end

    def kept(df: DataFrame, label: str) -> DataFrame:
        scratch.append(written(df, label))
        return scratch[-1]

    sets = written(rows.mapInArrow(read, "id long, n long, key binary, least array<long>, parity array<long>"), "join-sets")
    of_key = [F.min("id").alias("class"), *[F.first(c).alias(c) for c in ("n", "least", "parity")], F.count(F.lit(1)).alias("copies")]
    classes = kept(sets.where("n > 0").groupBy("key").agg(*of_key), "join-classes")
    # sets of one minimum hash against one of them; later rounds take other hashes and other pivots, for those left apart
    links, found = None, None
    for turn, slots in enumerate(PIVOT_ROUNDS):
        hashed = classes.select("class", "n", "parity", F.posexplode("least").alias("which", "hash")).where(F.col("which").isin(list(slots)))
        if found is None:
            hashed = hashed.withColumn("component", F.col("class"))
        else:
            known = found.select(F.col("v").alias("class"), "label")
            hashed = hashed.join(known, "class", "left").withColumn("component", F.coalesce("label", "class")).drop("label")
        turns = (F.col("class"), F.bitwise_not("class"), F.xxhash64("class"))
        pivot = [F.col(c).alias(f"pivot_{c}") for c in ("n", "parity")]
        first = F.min(F.struct(turns[turn % 3].alias("place"), F.col("class").alias("pivot"), F.col("component").alias("of"), *pivot)).alias("p")
        groups = hashed.groupBy("which", "hash").agg(first, F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        pivots = kept(groups.select("which", "hash", "p.pivot", "p.of", "p.pivot_n", "p.pivot_parity"), "join-pivots")
        apart = sum(F.bit_count(F.col("parity")[k].bitwiseXOR(F.col("pivot_parity")[k])) for k in range(PARITY_WORDS))
        may_link = (7 * apart <= F.col("n") + F.col("pivot_n")) & (4 * F.least("n", "pivot_n") >= 3 * F.greatest("n", "pivot_n"))
        near = hashed.join(pivots, ["which", "hash"]).where((F.col("component") != F.col("of")) & may_link)
        near = kept(near.select(F.least("pivot", "class").alias("a"), F.greatest("pivot", "class").alias("b")).distinct(), "join-near")
        new = kept(_linked(near, _texts_of(rows, near, kept)), "join-links")
        links = new if links is None else kept(links.unionByName(new), "join-links")
        found = components(links)
        scratch.append(found)
    # what the index has to know of each document: the ones without a class of their own are left out
    copies = sets.join(classes.where("copies > 1").select("key", "class"), "key").select("id", "class")
    copies = copies.groupBy("id").agg(F.min("class").alias("class")).where(F.col("id") != F.col("class")).select("id", F.lit(None).cast("long").alias("component"))
    known = copies.unionByName(found.select(F.col("v").alias("id"), F.col("label").alias("component")))
    known = kept(known.groupBy("id").agg(F.max("component").alias("component"), F.lit(True).alias("is_known")), "join-known")
    marked = sized_join(rows, known, "id", "left", known.count(), MOST_ROWS)
    single = marked.where(F.col("is_known").isNull() | F.col("component").isNotNull())
    single = single.select("id", F.coalesce("component", "id").alias("component"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            for part in slices(batch, "text", STEP):
                values, _ = shingle_sets(part.column(2))
                cells += np.bincount((values >> np.uint64(42)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
        chunk = 1 << 16
        for i in range(0, SKETCH, chunk):
            packed = zstandard.compress(cells[i : i + chunk].tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([i // chunk], pa.int32()), pa.array([packed], pa.binary())], ["chunk", "cells"])

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.minimum(sum(np.frombuffer(zstandard.decompress(c), np.uint32).astype(np.uint64) for c in parts["cells"]), 0xFFFFFFFF).astype(np.uint32)
        return pd.DataFrame({"chunk": parts["chunk"].iloc[:1], "cells": [zstandard.compress(total.tobytes(), 1)]})

    counted = single.mapInArrow(count, "chunk int, cells binary")
    # in a tree: a group adds the pieces of some thousand tasks at most, then the sums of some thousand groups
    counted = counted.groupBy("chunk", F.shiftright(F.spark_partition_id(), 10)).applyInPandas(add, "chunk int, cells binary")
    chunks = counted.groupBy("chunk").applyInPandas(add, "chunk int, cells binary").collect()
    cells = {r["chunk"]: zstandard.decompress(bytes(r["cells"])) for r in chunks}
    empty = bytes(4 << 16)
    sketch = spark.sparkContext.broadcast(b"".join(cells.get(i, empty) for i in range(SKETCH >> 16)))  # 16 MB whatever the input
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    entries = _entries(single, sketch, max(1, int(total * 0.3 / BUCKET_ROWS) + 1))
    pairs = kept(_candidates(entries), "join-pairs")
    every, final = _verified(pairs, rows, links, found, kept)
    degree = every.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n_links"))
    of_class = classes.select("key", "class").join(final.withColumnRenamed("v", "class"), "class", "left").join(degree, "class", "left")
    of_class = written(of_class.select("key", "class", F.coalesce("label", "class").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "join-of-class")
    for df in scratch:
        forget(df)
    sketch.destroy()
    out = sets.select("id", "n", "key").join(of_class, "key", "left")
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(
        real("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), real("id")).otherwise(real("component")).alias("component_id"),
        F.when(F.col("key").isNull(), real("id")).otherwise(real("class")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the smallest of their component (rows of one id stay or go together)."""
    gone, dropped = fresh(docs.columns, "__gone", "__dropped")
    found = similar(docs, id_column, text_column)
    lost = written(found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(gone)).distinct(), "near-copies")
    return sized_join(docs, lost, F.col(f"`{id_column}`").cast("long").eqNullSafe(F.col(gone)), "left_anti", lost.count(), MOST_ROWS)
