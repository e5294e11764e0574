"""Words of many texts at once: places, hashes and lines, from the bytes of a whole column."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from linetally.llm.common import utf8

#: Bytes with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2^64, and of its inverse."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


@dataclass
class Words:
    """Words of a run of texts, in order.

    ``data`` holds the bytes (A-Z lowered), ``begin`` and ``end`` each word's place in them, ``doc`` its text's number,
    ``first`` (one longer than the texts) the number of each text's first word.
    """

    data: np.ndarray
    text_at: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, column: pa.Array, is_word: np.ndarray) -> Words:
        """``is_word``: for each of 256 bytes, whether words are made of it."""
        raw, at = utf8(column)
        data = LOWER[raw]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = is_word[data]
        begins = inside[1:-1] & ~inside[:-2]
        ends = inside[1:-1] & ~inside[2:]
        cuts = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]  # a word ends where its text does
        begins[cuts] = inside[1:-1][cuts]
        ends[cuts - 1] = inside[1:-1][cuts - 1]
        begin = np.flatnonzero(begins)
        first = np.searchsorted(begin, at)
        return cls(data, at, begin, np.flatnonzero(ends) + 1, np.repeat(np.arange(len(at) - 1), np.diff(first)), first)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash for each word, the same wherever the word stands."""
        if not len(self.begin):
            return np.zeros(0, np.uint64)
        up, down = powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        return mixed((total[self.end] - total[self.begin]) * down[self.begin])

    def lines(self) -> np.ndarray:
        """A number for each word's line; lines do not go on into the next text."""
        return np.searchsorted(np.flatnonzero(self.data == 10), self.begin) + self.doc

    def word(self, i: int) -> bytes:
        return self.data[self.begin[i] : self.end[i]].tobytes()


def word_bytes(pieces: str) -> np.ndarray:
    """A table for ``Words.of``: ``alnum`` (letters, digits, all beyond ASCII) or ``solid`` (all but ASCII white space)."""
    table = np.zeros(256, bool)
    if pieces == "alnum":
        table[48:58] = table[97:123] = table[65:91] = table[128:] = True
    else:
        table[:] = True
        table[[9, 10, 11, 12, 13, 32]] = False
    return table


def hash_of(word: str) -> int:
    """The hash that ``Words.hashes`` gives to this word."""
    w = Words.of(pa.array([word]), np.ones(256, bool))
    return int(w.hashes()[0])
