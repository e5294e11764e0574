"""Helpers the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_SHIPPED: set[str] = set()


#: Rows handed to Python at once: texts are long, and Spark's default of 10,000 rows of them takes much memory.
BATCH_ROWS = "1000"
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application, as ``--py-files`` would, and keep Arrow batches
    small unless the session says otherwise than Spark's default."""
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        to = Path(tempfile.mkdtemp(prefix="linetally-code-")) / f"{package.name}.zip"  # Spark's file server reads it
        with zipfile.ZipFile(to, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(to))
        _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """Names for helper columns that clash with none of ``columns`` (compared without case)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def learns(doc_id: str, modulus: int, held: int) -> Column:
    """True where the unsigned crc32 of the id as text leaves another remainder than ``held``."""
    return ~held_out(doc_id, modulus, held)


def held_out(doc_id: str, modulus: int, held: int) -> Column:
    """True where the unsigned crc32 of the id as text leaves the remainder ``held``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == held, F.lit(False))


def last_drawn(most: int, rows: int) -> int:
    """The greatest 63-bit hash that is drawn if about ``most`` of so many rows are to be; the greatest of all where
    there are no more rows."""
    return most * (1 << 63) // max(1, rows, most) - 1


def hash_63(*columns: str | Column) -> Column:
    """A hash from 0 to 2^63 - 1."""
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << 63) - 1))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, one after another, and the n + 1 offsets of its rows; null is empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    elif pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


_LEAN = False


def lean() -> None:
    """Have a Python worker give freed arrays of 4 MB or more back to the system at once.

    By default the C library keeps ever larger ones for reuse, and a worker that serves task after task holds on to
    the most it ever needed. Where there is no such setting, nothing happens.
    """
    global _LEAN
    if not _LEAN:
        _LEAN = True
        with contextlib.suppress(OSError, AttributeError):
            library = ctypes.CDLL(None)
            library.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD
            library.mallopt(-1, 16 << 20)  # M_TRIM_THRESHOLD
    pa.default_memory_pool().release_unused()


def give_back() -> None:
    """Have a Python worker give freed memory, small objects' too, back to the system, where the C library can."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold up to ``most_bytes`` of text each; a longer row comes alone."""
    lean()
    _, at = utf8(batch.column(batch.schema.get_field_index(column)))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most_bytes, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def sized_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str, right_rows: int, most_rows: int) -> DataFrame:
    """Join; ``right`` is broadcast only if it has at most ``most_rows`` rows, and shuffled like ``left`` beyond that."""
    return left.join(F.broadcast(right) if right_rows <= most_rows else right, on, how)
