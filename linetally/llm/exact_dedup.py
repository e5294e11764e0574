"""Exact dedup by two passes over a Bloom filter with counted cells.

Pass one puts the hash of every text into a blocked filter: the hash names a chunk of 65,536 cells and three cells of
it. A task counts its own hashes (a cell is met once, or more often) and hands on the met cells, chunk by chunk, two
bytes each; the tasks' findings meet per chunk. Only cells met at least twice are kept. A text that occurs twice has
met each of its cells twice, so none is missed.

Pass two tests every row against the kept cells in the scan. Rows that fail the test have no copy and pass straight
through. Only the others are shuffled, and they decide exactly, by SHA-256.

The filter takes about eight cells a row, up to ``most_chunks`` chunks (8 KB each): this bounds what is broadcast. For
more rows than about 8,000 a chunk the cells fill up, more rows without a copy are shuffled, and results stay the same.

Null text counts as the empty text, so nulls and empty texts are one group. Rows that repeat id and text are all marked
kept by ``exact_dedup`` (it marks the row with the largest id) and are one row in ``without_copies``. Null ids are
below all others. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.env import written
from linetally.llm.common import fresh, ship, whole_text

CELLS = 1 << 16
ROWS_PER_CHUNK = CELLS // 8
#: 64 MB of filter: 67 million rows at eight cells each.
MOST_CHUNKS = 1 << 13


def _repeated_cells(hashes: DataFrame, chunks: int) -> DataFrame:
    """Per chunk the cells met at least twice, as 1,024 words of 64 bits; chunks without one are left out."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, size = [], 0

        def folded() -> tuple[np.ndarray, np.ndarray]:
            """Cells met, each once or (if met more often) twice."""
            cells, times = np.unique(np.concatenate(seen), return_counts=True)
            return cells, times

        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            chunk = (h >> np.uint64(48)) * np.uint64(chunks) >> np.uint64(16)
            seen += [chunk << np.uint64(16) | h >> np.uint64(s) & np.uint64(CELLS - 1) for s in (0, 16, 32)]
            size += 3 * len(h)
            if size > 1 << 22:  # fold what has gathered, so that copies take no room
                cells, times = folded()
                seen, size = [np.repeat(cells, np.minimum(times, 2))], 0
        if not seen:
            return
        cells, times = folded()
        chunk = (cells >> np.uint64(16)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(chunk, prepend=-1, append=-2)) if len(chunk) else []
        low = (cells & np.uint64(CELLS - 1)).astype("<u2")
        rows = [(int(chunk[a]), low[a:b].tobytes(), low[a:b][times[a:b] > 1].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for at in range(0, len(rows), 4096):
            a, b, c = zip(*rows[at : at + 4096], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.binary()), pa.array(c, pa.binary())], ["chunk", "once", "twice"])

    def join(part: pd.DataFrame) -> pd.DataFrame:
        cells, times = np.unique(np.frombuffer(b"".join([*part["once"], *part["twice"]]), "<u2"), return_counts=True)
        bits = np.zeros(CELLS, np.uint8)
        bits[cells[times > 1]] = 1
        words = np.packbits(bits, bitorder="little").view("<i8")
        return pd.DataFrame({"chunk": part["chunk"].iloc[:1], "words": [words]}) if words.any() else pd.DataFrame({"chunk": [], "words": []})

    ship(hashes.sparkSession)
    found = hashes.mapInArrow(met, "chunk int, once binary, twice binary")
    return found.groupBy("chunk").applyInPandas(join, "chunk int, words array<long>")


def _tested(rows: DataFrame, hash_column: str, filter_table: DataFrame, chunks: int, flag: str) -> DataFrame:
    """``rows`` with a column that is true where the text may have a copy."""
    chunk, words = fresh(rows.columns, "__chunk", "__words")
    kept = filter_table.select(F.col("chunk").alias(chunk), F.col("words").alias(words))

    def met(shift: int) -> Column:
        word = f"get(`{words}`, cast(shiftrightunsigned(`{hash_column}`, {shift + 6}) & 1023 as int))"
        return F.expr(f"(shiftrightunsigned({word}, cast(shiftrightunsigned(`{hash_column}`, {shift}) & 63 as int)) & 1L) = 1L")

    at = F.shiftrightunsigned(F.shiftrightunsigned(hash_column, 48) * chunks, 16).cast("int")
    found = rows.withColumn(chunk, at).join(F.broadcast(kept), chunk, "left")
    return found.withColumn(flag, F.coalesce(met(0) & met(16) & met(32), F.lit(False))).drop(chunk, words)


def _chunks(rows: int, most: int) -> int:
    return max(1, min(most, -(-rows // ROWS_PER_CHUNK)))


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", most_chunks: int = MOST_CHUNKS) -> DataFrame:
    """One row per document: doc_id, keep_id (largest id with this text), group_size, kept, text_sha256."""
    text = whole_text(text_column)
    rows = written(
        docs.select(F.col(id_column).alias("doc_id"), F.sha2(text, 256).alias("text_sha256"), F.xxhash64(text).alias("hash")), "exact-rows"
    )
    chunks = _chunks(rows.count(), most_chunks)
    cells = written(_repeated_cells(rows.select("hash"), chunks), "exact-filter")
    tested = _tested(rows, "hash", cells, chunks, "repeats")
    alone = tested.where(~F.col("repeats")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    shared = tested.where("repeats").select("doc_id", "text_sha256")
    # copies fold in the tasks before they are shuffled, so a hot text costs a row per task
    groups = shared.groupBy("text_sha256").agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    shared = shared.join(written(groups, "exact-groups"), "text_sha256", "left")
    # without a group a row stands for itself
    keep = F.when(F.col("rows").isNull(), F.col("doc_id")).otherwise(F.col("top"))
    shared = shared.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256"
    )
    return alone.unionByName(shared)


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", most_chunks: int = MOST_CHUNKS) -> DataFrame:
    """The rows of ``docs`` with one row of each text: that with the largest id (ties by the other columns' hash)."""
    text = whole_text(text_column)
    hash_column, flag, whole = fresh(docs.columns, "__hash", "__repeats", "__whole")
    hashed = docs.withColumn(hash_column, F.xxhash64(text))
    hashes = written(hashed.select(F.col(hash_column).alias("hash")), "exact-hashes")
    chunks = _chunks(hashes.count(), most_chunks)
    cells = written(_repeated_cells(hashes, chunks), "exact-filter")
    tested = _tested(hashed, hash_column, cells, chunks, flag)
    alone = tested.where(~F.col(flag)).select(*docs.columns)
    plain = [f.name for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    first = F.struct(F.col(id_column), F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
    rows = tested.where(flag).groupBy(F.sha2(text, 256).alias("__key")).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), first).alias(whole)
    )
    return alone.unionByName(rows.select(f"{whole}.*"))
