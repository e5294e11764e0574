"""Token ids in files: tokenize whole texts, write them in ascending document order, read them back.

Texts are range-partitioned by id (with the text's hash and a row number, so that a repeated or null id is split too)
and sorted in their tasks. Each task tokenizes its texts in order and writes segments of whole documents, about
``segment_ids`` ids each, in the format of ``range_coder``. A file is a Parquet table of one partition's segments; it
can lie on any store Spark writes to. Where a segment stands is kept beside it: the part, its number there, and the ids
of the part before it. Parts are few, so where each part starts is a sum over parts.

Null text is the empty text: the end id alone. Null ids come first. Rows that repeat are written each for itself, next
to each other. An empty table gives no segment and an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linetally.env import scratch_path
from linetally.llm.common import ship, slices
from linetally.llm.range_coder import read_segment, write_segment
from linetally.llm.tokens import word_tokenizer

END_ID = 2
SEGMENT_IDS = 1 << 22
STEP = 4 << 20

SEGMENTS = "part int, segment int, part_before long, n_ids long, n_docs long, data binary"


def write_tokens(
    docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Write all documents of ``docs`` under ``path``."""
    ship(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer)
        end = np.array([end_id], words.dtype)
        part, number, before = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        parts: list[np.ndarray] = []
        held = 0

        def segment() -> pa.RecordBatch:
            nonlocal number, before, held
            all_ids = np.concatenate(parts)
            row = [[part], [number], [before], [len(all_ids)], [len(ids)], [write_segment(ids, [len(p) for p in parts], all_ids)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            number, before, held = number + 1, before + len(all_ids), 0
            ids.clear()
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], [x.split(" ")[0] for x in SEGMENTS.split(", ")])

        for batch in batches:
            for some in slices(batch, "text", STEP):
                for doc, found in zip(some.column(0).to_pylist(), words.many(some.column(1).to_pylist()), strict=True):
                    got = np.concatenate([found, end])
                    ids.append(doc)
                    parts.append(got)
                    held += len(got)
                    if held >= segment_ids:
                        yield segment()
        if ids:
            yield segment()
        words.forget()

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("doc_id", "hash", "row").sortWithinPartitions("doc_id", "hash", "row")
    ordered.select("doc_id", "text").mapInArrow(encode, SEGMENTS).write.mode("errorifexists").option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and
    (``with_ids``) its ids as little-endian unsigned 32-bit integers. Damaged blocks raise."""
    ship(spark)
    segments = spark.read.schema(SEGMENTS).parquet(path)
    # one row a part: sums and the window see as many rows as there are files
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    placed = segments.join(F.broadcast(starts), "part").select((F.col("part_start") + F.col("part_before")).alias("start"), "data")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                docs, lengths, ids = read_segment(data.as_py())
                at = np.concatenate([[0], np.cumsum(lengths)])
                whole = ids.astype("<u4")
                cut = [whole[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, pa.int64()),
                        pa.array(at[:-1] + start),
                        pa.array(lengths),
                        pa.array([zlib.crc32(x) for x in cut], pa.int64()),
                        pa.array(cut if with_ids else [None] * len(cut), pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """Write to shared scratch and read back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_tokens(docs, tokenizer, path)
    return read_tokens(docs.sparkSession, path, with_ids)
