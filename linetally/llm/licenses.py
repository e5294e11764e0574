"""License scan: fixed phrases, and an exact set-similarity join of text blocks with license templates.

A block is a run of lines of a text that follow each other, none of them without words. A template is met where the block
holds at least ``threshold`` of the template's distinct words (containment) and no shorter run inside it does: that is a
line, or the lines over which a template wraps. The join is exact and compares few pairs. Its filters look at paragraphs,
the longest such runs:

* words are ordered by how often they occur in the whole corpus, rarest first (one counting pass over all texts; only
  the templates' words matter);
* prefix filter: of a template with n words of which k have to be met, one of the n - k + 1 rarest is in the paragraph;
* length filter: the paragraph has at least k words;
* positional filter: the words after the first common one, on either side, suffice for k;
* what is left is counted in full, along the paragraph's lines.

Null text counts as empty: no words, null places, empty labels, score 0. A line of any length is one block. Rows that
repeat are scanned each for itself. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetally.llm.common import ship, slices
from linetally.llm.words import Words, hash_of, word_bytes

PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this program comes with absolutely no warranty", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("this is free and unencumbered software released into the public domain", "public-domain"),
    ("copyright all rights reserved", "all-rights-reserved"),
)
THRESHOLD = 0.9
STEP = 4 << 20

RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, blocks array<struct<label: string, first_word: long, last_word: long, containment: double>>"
)


class _Vocabulary:
    """The words of templates and phrases, numbered."""

    def __init__(self, templates: tuple, phrases: tuple):
        self.words = sorted({w for text, _ in (*templates, *phrases) for w in text.split()})
        hashes = np.array([hash_of(w) for w in self.words], np.uint64)
        self.number = np.argsort(hashes)
        self.hashes = hashes[self.number]
        self.code = {w: i for i, w in enumerate(self.words)}

    def read(self, found: Words) -> np.ndarray:
        """Each word's number, or -1."""
        h = found.hashes()
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        codes = np.where(self.hashes[at] == h, self.number[at], -1)
        size = found.end - found.begin  # a hash alone could err
        return np.where((codes >= 0) & (size == np.array([len(w.encode()) for w in self.words])[codes]), codes, -1)


def word_counts(docs: DataFrame, text_column: str, words: _Vocabulary) -> dict[str, int]:
    """How often each word of the templates stands in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(words.words) + 1, np.int64)
        table = word_bytes("alnum")
        for batch in batches:
            for part in slices(batch, "text", STEP):
                n += np.bincount(words.read(Words.of(part.column(0), table)) + 1, minlength=len(n))
        yield pa.RecordBatch.from_arrays([pa.array(words.words), pa.array(n[1:])], ["word", "n"])

    rows = docs.select(F.col(text_column).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in rows.collect()}  # as many rows as the templates have words


def license_scan(
    docs: DataFrame,
    templates: tuple = TEMPLATES,
    phrases: tuple = PHRASES,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: words, base places and labels, all labels, the best containment (1 for a phrase), and the
    blocks that meet a template with their first and last word."""
    ship(docs.sparkSession)
    vocabulary = _Vocabulary(templates, phrases)
    often = word_counts(docs, text_column, vocabulary)
    rank = {w: i for i, w in enumerate(sorted(vocabulary.words, key=lambda w: (often.get(w, 0), w)))}
    order = np.array([rank[w] for w in vocabulary.words])
    sets = []  # ranks ascending (rarest first), words to be met, label
    for text, label in templates:
        ranks = sorted(rank[w] for w in set(text.split()))
        sets.append((ranks, math.ceil(threshold * len(ranks) - 1e-9), label))
    starts: dict[int, list[tuple[int, int]]] = {}
    for t, (ranks, need, _) in enumerate(sets):
        for i, r in enumerate(ranks[: len(ranks) - need + 1]):
            starts.setdefault(r, []).append((t, i))
    rare = np.zeros(len(order), bool)
    rare[list(starts)] = True
    base = [([vocabulary.code[w] for w in text.split()], label) for text, label in phrases]

    def runs(at: np.ndarray, lines: np.ndarray, ranks: list[int], need: int) -> Iterator[tuple[int, int, int]]:
        """Shortest runs of lines that hold ``need`` of the ranks: first and last line, ranks held. ``at``: a rank a word, or -1."""
        own = np.flatnonzero(np.isin(at, ranks))
        held: Counter[int] = Counter()
        left, last = 0, -1
        ends = np.append(np.flatnonzero(np.diff(lines[own])) + 1, len(own)).tolist()
        words, rows = at[own].tolist(), lines[own].tolist()
        for start, end in zip([0, *ends[:-1]], ends, strict=True):
            held.update(words[start:end])
            best = None
            while len(held) >= need:
                best = rows[left], rows[start], len(held)
                row = rows[left]
                while left < end and rows[left] == row:
                    held[words[left]] -= 1
                    if not held[words[left]]:
                        del held[words[left]]
                    left += 1
            if best and best[0] > last:
                last = best[0]
                yield best

    def blocks_of(codes: np.ndarray, lines: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, str, float]]:
        """Blocks that meet a template: first and last word (in the slice), label, containment."""
        known = np.flatnonzero(codes >= 0)
        hits = known[rare[order[codes[known]]]]
        # paragraphs: lines with words that follow each other in one text
        step = np.diff(lines)
        paragraph = np.concatenate([[0], np.cumsum((step > 1) | (np.diff(doc) > 0))]) if len(lines) else lines
        for p in np.unique(paragraph[hits]):
            a, b = np.searchsorted(paragraph, [p, p + 1])
            got = np.where(codes[a:b] >= 0, order[codes[a:b]], -1)
            block = np.unique(got[got >= 0]).tolist()
            tried = set()
            for j, r in enumerate(block):
                for t, i in starts.get(r, ()):
                    ranks, need, label = sets[t]
                    if t in tried or b - a < need:
                        continue
                    tried.add(t)
                    if 1 + min(len(ranks) - i - 1, len(block) - j - 1) < need:
                        continue
                    if len(set(ranks).intersection(block)) >= need:
                        for first, last, common in runs(got, lines[a:b], ranks, need):
                            x, y = np.searchsorted(lines[a:b], [first, last + 1])
                            yield int(a + x), int(a + y) - 1, label, common / len(ranks)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_bytes("alnum")
        names = [f.split(" ")[0] for f in RESULT.split(", ")[:8]] + ["blocks"]
        block_type = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("containment", pa.float64())]))
        for batch in batches:
            for part in slices(batch, "text", STEP):
                found = Words.of(part.column(1), table)
                codes = vocabulary.read(found)
                n = part.num_rows
                places: list[list[int]] = [[] for _ in range(n)]
                labels: list[set[str]] = [set() for _ in range(n)]
                for phrase, label in base:
                    at = np.flatnonzero(codes[: len(codes) - len(phrase) + 1] == phrase[0]) if len(codes) >= len(phrase) else []
                    for i in at:
                        d = found.doc[i]
                        if found.doc[i + len(phrase) - 1] == d and codes[i : i + len(phrase)].tolist() == phrase:
                            places[d].append(int(i - found.first[d]))
                            labels[d].add(label)
                blocks: list[list[dict]] = [[] for _ in range(n)]
                for a, b, label, share in blocks_of(codes, found.lines(), found.doc):
                    d = found.doc[a]
                    blocks[d].append({"label": label, "first_word": a - int(found.first[d]), "last_word": b - int(found.first[d]), "containment": share})
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(found.first), pa.int64()),
                        pa.array([len(p) for p in places], pa.int64()),
                        pa.array([min(p, default=None) for p in places], pa.int64()),
                        pa.array([max(p, default=None) for p in places], pa.int64()),
                        pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                        pa.array([",".join(sorted(x | {b["label"] for b in y})) for x, y in zip(labels, blocks, strict=True)], pa.string()),
                        pa.array([max([1.0 * bool(x), *(b["containment"] for b in y)]) for x, y in zip(labels, blocks, strict=True)], pa.float64()),
                        pa.array(blocks, block_type),
                    ],
                    names,
                )

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(scan, RESULT)
