"""Spelling variants: words one edit apart, each led to its far more frequent form.

Words are counted with built-in expressions; only the vocabulary goes on. Two words one edit apart are equal before the
edit and after it, so they are found by dense prefix-suffix tiling:

* A band holds the words of ``length`` code points (the shorter or equal ones of its pairs) and those with one more. Its
  words are grouped by the first half, and once more by the second half, since an edit leaves one of the two as it is.
* A group with more than ``MOST_TOGETHER`` words is divided again, at the middle of the part that is still open, until
  the groups are small. A group whose open part is one code point holds words that are one edit apart as good as all, and
  is as small as the alphabet squared. So the work follows the vocabulary, not the square of a frequent prefix.
* A task lays the code points of many groups out in two padded matrices, aligned left and right, and compares blocks of
  rows: where common prefix and suffix reach the longer length minus one, the words are one edit apart. A pair is counted
  in the one group whose open part holds the end of its common prefix.

A pair is folded in its task to a count and a best neighbour a word; pairs are never put out.

Rows: null and empty texts have no words; a null id reads as an empty one. Repeated rows count each. Of equally frequent
neighbours the smallest in code-point order is taken. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.env import written
from linetally.llm.common import ship

#: Code points and occurrences a word needs.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form is at least this many times as frequent as its variant.
TIMES = 10
#: Runs whose hash this divides lose a code point: noise to be found again.
NOISE = 31
#: Groups with more words are divided further.
MOST_TOGETHER = 64
#: Code points laid out at once.
CELLS = 1 << 20

NEAR = "word string, n_near long, best_n long, best string"


def noisy(run: Column, doc_id: Column, every: int = NOISE) -> Column:
    """The run without one code point, where ``every`` divides the hash of document and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % every == 0, without).otherwise(run)


def vocabulary(docs: DataFrame, noise: int | None = NOISE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word`` and its occurrences ``n``: runs of letters up to U+00FF, A-Z lower-cased, long and frequent enough."""
    runs = F.regexp_extract_all(text_column, F.lit(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}"), F.lit(0))
    runs = docs.select(F.col(id_column).alias("doc"), F.explode(runs).alias("run"))
    run = F.translate("run", ascii_uppercase, ascii_lowercase)
    words = runs.select("doc", run.alias("run")).select((noisy(F.col("run"), F.col("doc"), noise) if noise else F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` (word, n, band, and the open part from ``first`` to before ``last``) with the key of what is closed."""
    before = F.substring(F.col("word"), F.lit(1), F.col("first"))
    after = F.when(F.col("band") > F.col("last"), F.expr("right(word, band - last)")).otherwise("")
    return rows.withColumn("key", F.xxhash64("band", "first", "last", before, after))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row for the left and for the right half of its open part."""
    middle = F.expr("first + (last - first) div 2").cast("int")
    half = F.explode(F.array(F.struct(F.col("first"), middle.alias("last")), F.struct(middle.alias("first"), F.col("last"))))
    return _keyed(rows.select("word", "n", "band", half.alias("half")).select("word", "n", "band", "half.first", "half.last"))


def grouped(words: DataFrame, most_together: int = MOST_TOGETHER) -> DataFrame:
    """Words by group, in groups of at most ``most_together`` words but for those that cannot be divided."""
    band = F.explode(F.array(F.char_length("word"), F.char_length("word") - 1)).alias("band")
    whole = words.select("word", "n", band).withColumn("first", F.lit(0)).withColumn("last", F.col("band"))
    rows = written(_halves(whole.where("band > 0")), "spelling-groups")
    done = None
    while True:
        large = written(rows.where("last - first > 1").groupBy("key").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > most_together).select("key"), "spelling-large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = written(_halves(rows.join(large, "key").drop("key")), "spelling-groups")


def _common(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Equal cells at the beginning of each pair of rows, ``most`` at most."""
    differs = a != b
    return np.minimum(np.where(differs.any(1), differs.argmax(1), a.shape[1]), most)


def near_pairs(words: list[str], keys: np.ndarray, band: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows i < j of one group, one edit apart, whose common prefix ends in the group's open part.

    Groups lie one after another. Row i meets row i + d of its group, all rows at once, for d from 1 on.
    """
    length = np.fromiter(map(len, words), np.int64, len(words))
    width = int(length.max())
    points = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), "<u4").reshape(-1, width)
    from_end = np.frombuffer("".join(w[::-1].ljust(width, "\0") for w in words).encode("utf-32-le"), "<u4").reshape(-1, width)
    lefts, rights = [], []
    i = np.arange(len(words) - 1)
    d = 1
    while len(i):
        i = i[: np.searchsorted(i, len(words) - d)]
        i = i[keys[i] == keys[i + d]]  # the group of a row that has no d-th next one is through
        j = i + d
        shorter, longer = np.minimum(length[i], length[j]), np.maximum(length[i], length[j])
        use = (shorter == band[i]) & (band[i] == band[j])
        p, q, most = i[use], j[use], shorter[use]
        prefix = _common(points[p], points[q], most)
        good = prefix + _common(from_end[p], from_end[q], most) >= longer[use] - 1
        at = np.minimum(prefix, most - 1)
        good &= (first[p] <= at) & (at < last[p])
        lefts.append(p[good])
        rights.append(q[good])
        d += 1
    return np.concatenate(lefts) if lefts else i, np.concatenate(rights) if rights else i


def _folded(words: list[str], n: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[pa.Array]:
    """For each word its neighbours' number and the best of them."""
    me, other = np.concatenate([left, right]), np.concatenate([right, left])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], me))
    me, other = me[order], other[order]
    whose, start, count = np.unique(me, return_index=True, return_counts=True)
    best = other[start]
    return [pa.array([words[k] for k in whose], pa.string()), pa.array(count.astype(np.int64)), pa.array(n[best]), pa.array([words[k] for k in best], pa.string())]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Columns of whole groups, about ``CELLS`` code points at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows = sum(b.num_rows for b in held)
        width = int(batch.column(2)[batch.num_rows - 1].as_py()) + 1
        if rows * width >= CELLS:
            whole = pa.Table.from_batches(held).combine_chunks()
            keys = whole.column("key").to_numpy()
            ends = np.flatnonzero(keys[1:] != keys[:-1]) + 1  # groups end here; the last one may go on
            if len(ends):
                yield from _cut(whole.slice(0, int(ends[-1])))
                whole = whole.slice(int(ends[-1]))
            held = whole.to_batches()
    if held:
        yield from _cut(pa.Table.from_batches(held))


def _cut(rows: pa.Table) -> Iterator[tuple]:
    """Whole groups whose words fill about ``CELLS`` cells; a longer one comes alone."""
    keys, band = rows.column("key").to_numpy(), rows.column("band").to_numpy()
    starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]) | (band[1:] != band[:-1])) + 1, [len(keys)]])
    begin = 0
    for k in range(1, len(starts)):
        if k == len(starts) - 1 or (starts[k + 1] - starts[begin]) * (int(band[starts[k + 1] - 1]) + 1) > CELLS:
            part = rows.slice(int(starts[begin]), int(starts[k] - starts[begin]))
            yield part.column("word").to_pylist(), *(part.column(c).to_numpy() for c in ("n", "key", "band", "first", "last"))
            begin = k


def neighbours(words: DataFrame, most_together: int = MOST_TOGETHER) -> DataFrame:
    """``words`` (a table: word, n): those with words one edit apart, how many, and the most frequent of these."""
    ship(words.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, n, keys, band, first, last in _tiles(batches):
            left, right = near_pairs(text, keys, band, first, last)
            if len(left):
                yield pa.RecordBatch.from_arrays(_folded(text, n, left, right), ["word", "n_near", "best_n", "best"])

    rows = grouped(words, most_together).select("word", "n", "band", "first", "last", "key").repartition("key").sortWithinPartitions("band", "key")
    found = rows.mapInArrow(compare, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select("word", "n_near", (-F.col("top.less")).alias("best_n"), "top.best")


def _roots(forms: DataFrame) -> DataFrame:
    """``forms``: word, form. Returns word, root, the last word that forms lead to.

    A form is ``TIMES`` times as frequent, so chains are short and end; each round doubles the way done.
    """
    ways = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = written(ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if longer.where("moved").isEmpty():
            return ways
        ways = longer.drop("moved")


def variants(docs: DataFrame, noise: int | None = None, times: int = TIMES, most_together: int = MOST_TOGETHER, **columns: str) -> DataFrame:
    """One row per word: its form and root, its occurrences, words one edit apart and the form's occurrences.

    ``noise``: take a code point out of one run in so many (:func:`noisy`). ``columns``: ``id_column``, ``text_column``.
    """
    words = written(vocabulary(docs, noise, **columns), "spelling-words")
    leads = F.col("best_n") >= times * F.col("n")
    known = words.join(neighbours(words, most_together), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(leads, F.col("best")).alias("form"), F.when(leads, F.col("best_n")).alias("form_n")
    )
    known = written(known, "spelling-forms")
    roots = _roots(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
