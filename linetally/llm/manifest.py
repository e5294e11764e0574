"""Merkle manifest of a dataset: every row a leaf, 16 nodes a parent, a tree a source and a tree over the sources.

Time-forward processing. Nodes are labelled so that children come before their parents, and a node's digest is sent
ahead to the parent's label. Inside a task a heap ordered by label delivers the digests (at most 16 a level wait in it);
between tasks the same delivery is a shuffle sorted by label: a task takes the ``FAN ** LEVELS`` leaves under one node,
in order, and sends that node's digest on to the next round. The reversed sweep starts at the root: each node hands its
siblings and the suffix it was handed to its children, until every leaf holds the proof up to the root. There are as many
rounds as the tallest tree has levels, divided by ``LEVELS``, and each round has ``FAN ** LEVELS`` times fewer rows.

Places in a tree come from a range shuffle and one count a range, so a source of any size is spread over tasks; only
digests are shuffled, never texts.

Rows: null fields are ``-``. Leaves of a source ascend by id, null first; rows that share an id are ordered by digest, and
equal rows are leaves of their own. A null source is a source that comes first. An empty table gives an empty result.
Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linetally.env import written
from linetally.llm.common import ship

#: Children of a node, and levels that one task folds.
FAN, LEVELS = 16, 2
#: Leaves a range of the sorted table aims for.
RANGE_ROWS = 1_000_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves sent to Spark at once.
BATCH = 2_000

_HEX = 64
_NODE = "tree string, place long, nodes long, digest string"
_MESSAGE = "tree string, place long, slots array<int>, siblings array<string>, subroot string, root string"
_LEAF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_PROOF = ", slots array<int>, siblings array<string>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def row_digest(*fields: Column) -> Column:
    """SHA-256 in hex of all fields: ``-`` for null, else the bytes in UTF-8, a colon and the value as text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def height(nodes: int) -> int:
    """Levels above so many nodes."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FAN), levels + 1
    return levels


class Sweep:
    """The nodes above ``count`` leaves of one task, up to ``levels`` levels."""

    def __init__(self, count: int, levels: int) -> None:
        self.count, self.levels = count, levels

    def label(self, level: int, index: int) -> tuple[int, int, int]:
        """Leaves seen once the node is complete, then its level: a parent comes after all its children."""
        return min((index + 1) * FAN**level, self.count), level, index

    def up(self, leaves: Iterable[str], seen: Callable[[int, int, list[str]], None] | None = None) -> str:
        """The digest of the topmost node; ``seen`` is told the children of every node."""
        waiting: list[tuple[tuple[int, int, int], int, str]] = []
        top = ""

        def send(level: int, index: int, text: str) -> None:
            nonlocal top
            if level == self.levels:
                top = text
            else:
                heapq.heappush(waiting, (self.label(level + 1, index // FAN), index, text))

        for i, leaf in enumerate(leaves):
            send(0, i, leaf)
            while waiting and waiting[0][0][0] <= i + 1:
                label = waiting[0][0]
                children = []
                while waiting and waiting[0][0] == label:
                    children.append(heapq.heappop(waiting)[2])
                _, level, index = label
                if seen:
                    seen(level, index, children)
                send(level, index, digest("".join(children)))
        return top

    def down(self, leaves: list[str], slots: list[int], siblings: list[str]) -> Iterator[tuple[int, list[int], list[str]]]:
        """Each leaf's place with its proof: slot in its run and the others' digests, from the leaf's level up."""
        children: dict[tuple[int, int], list[str]] = {}
        self.up(leaves, lambda level, index, digests: children.__setitem__((level, index), digests))
        serial = 0
        waiting = [(tuple(-x for x in self.label(self.levels, 0)), serial, slots, siblings)]
        while waiting:
            label, _, slots, siblings = heapq.heappop(waiting)
            level, index = -label[1], -label[2]
            if level == 0:
                yield index, slots, siblings
                continue
            digests = children[level, index]
            for slot in range(len(digests)):
                serial += 1
                to = tuple(-x for x in self.label(level - 1, index * FAN + slot))
                others = "".join(digests[:slot]) + "".join(digests[slot + 1 :])
                heapq.heappush(waiting, (to, serial, [slot, *slots], [others, *siblings]))


def folded(leaf: str, slots: Sequence[int], siblings: Sequence[str]) -> str:
    """The root that a leaf and its proof lead to."""
    for slot, others in zip(slots, siblings):
        cut = _HEX * slot
        leaf = digest(others[:cut] + leaf + others[cut:])
    return leaf


def _block(place: str = "place") -> Column:
    return F.expr(f"{place} div {FAN**LEVELS}")


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[dict]]]:
    """Rows of a sorted partition by (tree, block), read as they come."""
    rows = (row for batch in batches for row in batch.to_pylist())
    return groupby(rows, key=itemgetter("tree", "block"))


def _sweep_of(first: dict, block: int) -> Sweep:
    width = FAN**LEVELS
    return Sweep(min(width, first["nodes"] - block * width), min(LEVELS, height(first["nodes"])))


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_TYPES = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([pa.field(name, _TYPES[kind]) for name, kind in (f.strip().split(" ") for f in ddl.split(", "))])


def _placed(nodes: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``nodes`` (a table) with their place in their tree, from 0, and the number of the tree's nodes."""
    parts = max(nodes.sparkSession.sparkContext.defaultParallelism, -(-nodes.count() // RANGE_ROWS))
    sort = [F.col("tree"), *order]
    ranged = nodes.repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
    ranged = written(ranged.withColumn("at", F.monotonically_increasing_id()), "manifest-ranged")
    part = F.shiftright("at", 33).alias("part")
    pieces = ranged.groupBy("tree", part).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range and tree
    pieces = pieces.select("tree", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("nodes"))
    return written(
        ranged.withColumn("part", part).join(pieces, ["tree", "part"]).withColumn("place", F.col("at") + F.col("shift")).drop("part", "at", "shift"),
        "manifest-placed",
    )


def _risen(nodes: DataFrame) -> DataFrame:
    """The next round: one node for each block of ``nodes``."""
    schema = _arrow(_NODE)

    def rise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (tree, block), members in _blocks(batches):
                first = next(members)
                sweep = _sweep_of(first, block)
                top = sweep.up(m["digest"] for m in (row for part in ([first], members) for row in part))
                yield tree, block, -(-first["nodes"] // FAN**LEVELS), top

        yield from _batches(rows(), schema)

    dealt = nodes.select("tree", _block().alias("block"), "place", "nodes", "digest").repartition("tree", "block")
    return written(dealt.sortWithinPartitions("tree", "block", "place").mapInArrow(rise, _NODE), "manifest-nodes")


def _rounds(placed: DataFrame) -> list[DataFrame]:
    """Nodes round by round, the last with one node a tree."""
    rounds = [placed]
    left = placed.agg(F.max("nodes")).first()[0] or 0
    while left > 1:
        rounds.append(_risen(rounds[-1]))
        left = -(-left // FAN**LEVELS)
    return rounds


def _with_messages(nodes: DataFrame, messages: DataFrame, *carried: str) -> DataFrame:
    """Rows by block, sorted by label; the block's message stands before its nodes."""
    both = messages.select("tree", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), "slots", "siblings", "subroot", "root").unionByName(
        nodes.select("tree", _block().alias("block"), "place", "nodes", "digest", *carried), allowMissingColumns=True
    )
    return both.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _sunk(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    """The message of each of ``nodes``, from those of their blocks."""
    schema = _arrow(_MESSAGE)

    def sink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (tree, block), members in _blocks(batches):
                told, *block_nodes = members
                sweep = _sweep_of(block_nodes[0], block)
                for i, slots, siblings in sweep.down([n["digest"] for n in block_nodes], told["slots"], told["siblings"]):
                    yield tree, block_nodes[i]["place"], slots, siblings, told["subroot"], told["root"]

        yield from _batches(rows(), schema)

    return _with_messages(nodes, messages).mapInArrow(sink, _MESSAGE)


def _proved(nodes: DataFrame, messages: DataFrame, with_proofs: bool) -> DataFrame:
    """The leaves with their proofs, as :func:`manifest` returns them."""
    ddl = _LEAF + (_PROOF if with_proofs else "")
    schema = _arrow(ddl)

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (_, block), members in _blocks(batches):
                told, *leaves = members
                sweep = _sweep_of(leaves[0], block)
                for i, slots, siblings in sweep.down([n["digest"] for n in leaves], told["slots"], told["siblings"]):
                    leaf = leaves[i]
                    root = folded(leaf["probe"] or leaf["digest"], slots, siblings)
                    row = leaf["doc_id"], leaf["digest"], told["subroot"], told["root"], digest("".join(siblings)), root, root == told["root"]
                    yield (*row, slots, siblings) if with_proofs else row

        yield from _batches(rows(), schema)

    return _with_messages(nodes, messages, "doc_id", "probe").mapInArrow(prove, ddl)


def manifest(
    docs: DataFrame,
    probe: Column | None = None,
    fields: Sequence[str] = FIELDS,
    with_proofs: bool = False,
    id_column: str = "doc_id",
    source_column: str = "source",
) -> DataFrame:
    """One row per document: its digest, the roots of its source and of all, its proof and the root folded from it.

    ``probe``: a digest to fold in place of the row's own, as :func:`row_digest` makes it of what a reader holds; null
    folds the row's own. ``verified`` says whether the root comes out. ``with_proofs`` adds the proof itself: for each
    level the slot in the run and the digests of the others, one after another.
    """
    spark = docs.sparkSession
    ship(spark)
    source = F.col(source_column).cast("string")
    leaves = docs.select(
        F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source)).alias("tree"),  # null first, then bytewise
        F.col(id_column).cast("long").alias("doc_id"),
        row_digest(*[F.col(f) for f in fields]).alias("digest"),
        (F.lit(None) if probe is None else probe).cast("string").alias("probe"),
    )
    # the serial number lets equal rows be split over ranges
    leaves = written(leaves.withColumn("serial", F.monotonically_increasing_id()), "manifest-leaves")
    leaves = _placed(leaves, [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("serial")])
    rounds = _rounds(leaves)
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    over = _rounds(_placed(written(subroots, "manifest-subroots"), [F.col("source")]))

    none = F.array().cast("array<int>"), F.array().cast("array<string>")
    messages = over[-1].select("tree", "place", none[0].alias("slots"), none[1].alias("siblings"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    for nodes in reversed(over[:-1]):
        messages = written(_sunk(nodes, messages), "manifest-messages")
    named = over[0].select("place", F.col("source").alias("of"), "digest")
    messages = messages.join(named, "place").select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("place"), "slots", "siblings", F.col("digest").alias("subroot"), "root")
    for nodes in reversed(rounds[1:-1]):
        messages = written(_sunk(nodes, messages), "manifest-messages")
    return _proved(leaves, messages, with_proofs)
