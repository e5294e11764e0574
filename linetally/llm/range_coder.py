"""Adaptive context-mixing range coder for token ids, many blocks at a time.

A block holds up to ``BLOCK`` ids and is coded alone: its models start anew and it carries a CRC-32 of its ids, so any
block can be read, or found damaged, without the others. Three predictions are mixed for every id:

* order 2: the id that last followed the same two ids, and how often in a row it was right;
* order 1: the same after one id;
* order 0: how often ids of each 256-wide range were met in the block, over the segment's own frequencies (rounded to
  eighths of a power of two, in its head), which also give the ids within a range.

The mixing weights of orders 2 and 1 are learned in the block: for each pair of confidences the share of hits so far.
The id is coded as one symbol of the mixed distribution (the two predicted ids, or a range of ids), then its low byte
where it was not predicted. All model arithmetic is on integers, so every machine reads the same.

The coder keeps 48 bits of state and moves 16 bits at a time. Digits are kept wide while coding, so a carry is added to
the last digit only and settled once at the end. All blocks of a segment advance together, one id a step.

File layout, little-endian. Segment: magic ``TIDS``, version (u16), 0 (u16), ids (u64), blocks (u32), documents (u32),
bytes of the frequencies (u32), documents as (id i64, ids u64), blocks as (ids u32, bytes u32, CRC-32 u32), frequencies
(deflated, one byte an id), CRC-32 of all up to here (u32), then the blocks' bytes.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 4096
MAGIC = b"TIDS"
VERSION = 1
#: Vocabularies of up to 65,536 ids: ranges of 256.
RANGES = 256
_TABLE = 1 << 11  # contexts per block and order
_TOTAL = 1 << 16
_MASK = np.uint64((1 << 48) - 1)
_LOW = np.uint64(1 << 32)
_PRIOR, _MET = 1 << 14, 32  # weight of the segment's frequencies, and of one id met
_REFRESH = 128  # ids between updates of the order-0 model
_SEEN = 32  # the least share of a predicted id
_LEAST = 1 << 12  # the share of order 0 never falls below 1/16


#: What a rounded frequency stands for: 0, or 16 times a power of two in eighths.
_WEIGHT = np.array([0, *(int(16 * 2 ** (q / 8)) for q in range(1, 256))], np.int64)


def frequencies(ids: np.ndarray) -> np.ndarray:
    """How often each id occurs, rounded to a byte."""
    n = np.bincount(ids, minlength=1)
    return np.where(n > 0, np.clip(np.rint(np.log2(np.maximum(n, 1)) * 8), 1, 255), 0).astype(np.uint8)


def _scaled(total: np.ndarray, least: int) -> np.ndarray:
    """Running sums (last axis) as parts of 65,536, each symbol having ``least`` parts at least."""
    n = total.shape[-1]
    return total * (_TOTAL - n * least) // np.maximum(total[..., -1:], 1) + least * np.arange(1, n + 1)


class _Order0:
    """Order-0 tables of a segment: a prior for ranges and the ids within each."""

    def __init__(self, rounded: np.ndarray):
        w = np.zeros(RANGES * 256, np.int64)
        w[: len(rounded)] = _WEIGHT[rounded]
        w = w.reshape(RANGES, 256)
        ranges = w.sum(1)
        self.prior = ranges * _PRIOR // max(1, int(ranges.sum())) + 1
        self.low = np.zeros((RANGES, 257), np.int64)
        self.low[:, 1:] = _scaled(np.cumsum(w, 1), 1)
        self.low[:, -1] = _TOTAL
        self.flat = self.low.reshape(-1)


class _Models:
    """The models of all lanes; coder and decoder run the same steps."""

    def __init__(self, lanes: int, order0: _Order0):
        self.lane = np.arange(lanes)
        self.base = self.lane * _TABLE
        self.guess = [np.zeros(lanes * _TABLE, np.uint16) for _ in range(2)]  # order 1, order 2
        self.trust = [np.zeros(lanes * _TABLE, np.uint8) for _ in range(2)]
        self.hits = np.full((2, lanes * 16), 1200, np.int64)  # of 65,536, for each pair of confidences
        self.counts = np.tile(order0.prior, (lanes, 1))
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.cum = np.zeros((lanes, RANGES + 1), np.int64)
        self.before = np.zeros((2, lanes), np.int64)  # last id, the one before
        self.refresh()

    def refresh(self) -> None:
        lanes = len(self.lane)
        if self.pending:
            keys = np.concatenate([lane * RANGES + r for lane, r in self.pending])
            self.counts += _MET * np.bincount(keys, minlength=lanes * RANGES).reshape(lanes, RANGES)
            self.pending.clear()
        # every range keeps 16 parts of 65,536 or more, so one at least of what order 0 gets
        self.cum[:, 1:] = _scaled(np.cumsum(self.counts, 1), 16)
        self.cum[:, -1] = _TOTAL

    def predict(self, m: int) -> None:
        """For the first m lanes: contexts, guesses and the parts of 65,536 given to each."""
        last, earlier = self.before[0, :m], self.before[1, :m]
        base = self.base[:m]
        self.at = [base + ((last * 0x9E37 >> 4) & (_TABLE - 1)), base + (((last * 0x9E3779B1 + earlier * 0x85EBCA6B) >> 16) & (_TABLE - 1))]
        self.said = [g[a].astype(np.int64) for g, a in zip(self.guess, self.at, strict=True)]
        t1, t2 = self.trust[0][self.at[0]].astype(np.int64), self.trust[1][self.at[1]].astype(np.int64)
        self.state = self.lane[:m] * 16 + np.minimum(t2, 3) * 4 + np.minimum(t1, 3)
        p2, p1 = self.hits[1][self.state], self.hits[0][self.state]
        f2 = np.clip(p2, _SEEN, _TOTAL - 2 * _LEAST)
        f1 = np.clip((_TOTAL - f2) * p1 >> 16, _SEEN, _TOTAL - _LEAST - f2)
        self.f2, self.f1, self.f0 = f2, f1, _TOTAL - f2 - f1

    def learn(self, m: int, ids: np.ndarray) -> None:
        hit2 = self.said[1] == ids
        hit1 = self.said[0] == ids
        self.hits[1][self.state] += ((hit2 * (_TOTAL - 1)) - self.hits[1][self.state]) >> 4
        miss = ~hit2
        s = self.state[miss]
        self.hits[0][s] += ((hit1[miss] * (_TOTAL - 1)) - self.hits[0][s]) >> 4
        for order, hit in ((0, hit1), (1, hit2)):
            at, trust = self.at[order], self.trust[order]
            now = trust[at]
            trust[at] = np.where(hit, np.minimum(now + 1, 3), 0)
            self.guess[order][at] = ids
        self.pending.append((self.lane[:m], ids >> 8))
        self.before[1, :m] = self.before[0, :m]
        self.before[0, :m] = ids
        if len(self.pending) == _REFRESH:
            self.refresh()


def _live(sizes: np.ndarray) -> list[int]:
    """For each step, how many of the lanes (longest first) still run."""
    return np.searchsorted(-sizes, -np.arange(1, int(sizes.max(initial=0)) + 1), "right").tolist()


def encode_blocks(ids: np.ndarray, order0: _Order0, block: int = BLOCK) -> list[bytes]:
    """The bytes of each block of ``block`` ids (the last may be shorter)."""
    n = len(ids)
    if not n:
        return []
    if int(ids.max()) >= RANGES * 256:
        raise ValueError("ids must be below 65,536")
    lanes = -(-n // block)
    sizes = np.full(lanes, block, np.int64)
    sizes[-1] = n - block * (lanes - 1)
    begin = np.arange(lanes) * block
    models = _Models(lanes, order0)
    low = np.zeros(lanes, np.uint64)
    width = np.full(lanes, int(_MASK), np.uint64)
    digits = np.zeros((lanes, 2 * block + 8), np.uint32)
    flat = digits.reshape(-1)
    place = np.arange(lanes) * digits.shape[1] + 1  # digit 0 takes a last carry, which never comes
    ids = ids.astype(np.int64)

    def put(m: int, cum: np.ndarray, part: np.ndarray) -> None:
        lo, wi, at = low[:m], width[:m], place[:m]
        wi >>= np.uint64(16)
        lo += wi * cum.astype(np.uint64)
        wi *= part.astype(np.uint64)
        carry = lo > _MASK
        if carry.any():
            flat[at[carry] - 1] += 1
            lo &= _MASK
        thin = wi < _LOW
        out = np.flatnonzero(thin)
        flat[at[out]] = lo[out] >> np.uint64(32)
        lo[out] = lo[out] << np.uint64(16) & _MASK
        wi[out] <<= np.uint64(16)
        at[out] += 1

    for t, m in enumerate(_live(sizes)):
        x = ids[begin[:m] + t]
        models.predict(m)
        by2 = models.said[1] == x
        by1 = ~by2 & (models.said[0] == x)
        cum = models.cum[:m]
        r = x >> 8
        low0 = cum[models.lane[:m], r] * models.f0 >> 16
        high0 = cum[models.lane[:m], r + 1] * models.f0 >> 16
        first = np.where(by2, 0, np.where(by1, models.f2, models.f2 + models.f1 + low0))
        part = np.where(by2, models.f2, np.where(by1, models.f1, high0 - low0))
        put(m, first, part)
        known = by2 | by1
        at = x + r  # rows of 257
        put(m, np.where(known, 0, order0.flat[at]), np.where(known, _TOTAL, order0.flat[at + 1] - order0.flat[at]))
        models.learn(m, x)
    for _ in range(3):  # the rest of the state
        flat[place] = low >> np.uint64(32)
        low = low << np.uint64(16) & _MASK
        place += 1
    count = place - np.arange(lanes) * digits.shape[1]
    for j in range(int(count.max()) - 1, 0, -1):  # settle the carries
        digits[:, j - 1] += digits[:, j] >> 16
        digits[:, j] &= 0xFFFF
    small = digits.astype("<u2")
    return [small[i, 1 : count[i]].tobytes() for i in range(lanes)]


def decode_blocks(blocks: list[bytes], sizes: np.ndarray, order0: _Order0) -> list[np.ndarray]:
    """The ids of each block, ``sizes`` of them."""
    lanes = len(blocks)
    if not lanes:
        return []
    order = np.argsort(-sizes, kind="stable")
    sizes_by = sizes[order]
    longest = max(map(len, blocks)) // 2 + 4
    digits = np.zeros((lanes, longest), np.uint64)
    for i, k in enumerate(order):
        d = np.frombuffer(blocks[k], "<u2")
        digits[i, : len(d)] = d
    flat = digits.reshape(-1)
    place = np.arange(lanes) * longest + 3
    code = digits[:, 0] << np.uint64(32) | digits[:, 1] << np.uint64(16) | digits[:, 2]  # code less low
    width = np.full(lanes, int(_MASK), np.uint64)
    out = np.zeros((lanes, int(sizes.max())), np.uint16)
    models = _Models(lanes, order0)

    def take(m: int, cum: np.ndarray, part: np.ndarray, unit: np.ndarray) -> None:
        c, wi, at = code[:m], width[:m], place[:m]
        c -= unit * cum.astype(np.uint64)
        wi[:] = unit * part.astype(np.uint64)
        thin = np.flatnonzero(wi < _LOW)
        c[thin] = c[thin] << np.uint64(16) | flat[np.minimum(at[thin], len(flat) - 1)]
        wi[thin] <<= np.uint64(16)
        at[thin] += 1

    for t, m in enumerate(_live(sizes_by)):
        models.predict(m)
        unit = width[:m] >> np.uint64(16)
        v = np.minimum(code[:m] // unit, np.uint64(_TOTAL - 1)).astype(np.int64)
        by2 = v < models.f2
        by1 = ~by2 & (v < models.f2 + models.f1)
        known = by2 | by1
        rest = np.flatnonzero(~known)
        # the range whose scaled bounds hold the value
        want, f0, row = v[rest] - (models.f2 + models.f1)[rest], models.f0[rest], models.lane[:m][rest] * (RANGES + 1)
        table = models.cum.reshape(-1)
        lo = np.zeros(len(rest), np.int64)
        for step in (128, 64, 32, 16, 8, 4, 2, 1):
            up = table[row + lo + step] * f0 >> 16 <= want
            lo += up * step
        low0, high0 = np.zeros(m, np.int64), np.zeros(m, np.int64)
        low0[rest] = table[row + lo] * f0 >> 16
        high0[rest] = table[row + lo + 1] * f0 >> 16
        first = np.where(by2, 0, np.where(by1, models.f2, models.f2 + models.f1 + low0))
        part = np.where(by2, models.f2, np.where(by1, models.f1, high0 - low0))
        take(m, first, part, unit)
        unit = width[:m] >> np.uint64(16)
        v = np.minimum(code[:m][rest] // unit[rest], np.uint64(_TOTAL - 1)).astype(np.int64)
        at = lo * 257
        for step in (128, 64, 32, 16, 8, 4, 2, 1):
            at += (order0.flat[at + step] <= v) * step
        first, part, x = np.zeros(m, np.int64), np.full(m, _TOTAL), np.where(by2, models.said[1], models.said[0])
        first[rest] = order0.flat[at]
        part[rest] = order0.flat[at + 1] - order0.flat[at]
        take(m, first, part, unit)
        x[rest] = at - lo
        out[:m, t] = x
        models.learn(m, x)
    ids: list[np.ndarray] = [np.zeros(0, np.uint16)] * lanes
    for i, k in enumerate(order):
        ids[k] = out[i, : sizes_by[i]]
    return ids


class Damaged(ValueError):
    """A block's ids do not have the checksum they were written with."""


def write_segment(docs: list[int | None], lengths: list[int], ids: np.ndarray, block: int = BLOCK) -> bytes:
    """One segment of whole documents; a null id is written as the smallest 64-bit number."""
    rounded = frequencies(ids) if len(ids) else np.zeros(0, np.uint8)
    coded = encode_blocks(ids, _Order0(rounded), block)
    parts = [ids[i * block : (i + 1) * block] for i in range(len(coded))]
    packed = zlib.compress(rounded.tobytes(), 6)
    head = struct.pack(_HEAD, MAGIC, VERSION, 0, len(ids), len(coded), len(docs), len(packed))
    index = np.array(list(zip([NO_ID if d is None else d for d in docs], lengths, strict=True)), "<i8").tobytes()
    table = b"".join(struct.pack("<III", len(p), len(c), zlib.crc32(p.astype("<u4").tobytes())) for p, c in zip(parts, coded, strict=True))
    front = b"".join([head, index, table, packed])
    return b"".join([front, struct.pack("<I", zlib.crc32(front)), *coded])


_HEAD = "<4sHHQIII"
NO_ID = -(1 << 63)


def read_segment(data: bytes, only: int | None = None) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Documents, their lengths, and all ids (or those of block ``only``). Raises ``Damaged`` at a wrong checksum."""
    magic, version, _, _, blocks, docs, tables = struct.unpack_from(_HEAD, data)
    if magic != MAGIC or version != VERSION:
        raise Damaged("not a segment of token ids")
    at = struct.calcsize(_HEAD)
    front = at + 16 * docs + 12 * blocks + tables
    if len(data) < front + 4 or zlib.crc32(data[:front]) != struct.unpack_from("<I", data, front)[0]:
        raise Damaged("head")
    index = np.frombuffer(data, "<i8", 2 * docs, at).reshape(docs, 2)
    at += 16 * docs
    table = np.frombuffer(data, "<u4", 3 * blocks, at).reshape(blocks, 3)
    at += 12 * blocks
    order0 = _Order0(np.frombuffer(zlib.decompress(data[at:front]), np.uint8))
    at = front + 4
    ends = np.cumsum(table[:, 1].astype(np.int64))
    which = range(blocks) if only is None else [only]
    got = decode_blocks([data[at + ends[i] - int(table[i, 1]) : at + ends[i]] for i in which], table[list(which), 0].astype(np.int64), order0)
    for i, ids in zip(which, got, strict=True):
        if zlib.crc32(ids.astype("<u4").tobytes()) != table[i, 2]:
            raise Damaged(f"block {i}")
    return [None if d == NO_ID else d for d in index[:, 0].tolist()], index[:, 1].copy(), np.concatenate(got) if got else np.zeros(0, np.uint16)
