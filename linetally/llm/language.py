"""Language identification by a linear-chain conditional random field over words.

Every word has a state, its language. Emissions come from the word's byte n-grams (two to four bytes), where those that
hold a word's edge are its affixes, and from a lexicon of words met often in training; transitions between languages and
the start are learned with them, by gradient ascent on the conditional likelihood of whole sequences. Training
sequences are spliced from parts of documents of different languages, as code-switched text is. Forward-backward gives
each word the probabilities of its languages; a text takes the language with the largest sum, and its score is the mean
probability of that language over all words.

Forward-backward is exact for any length: sequences are cut into blocks, each block's transfer matrix is built for all
blocks at once, a scan over blocks brings the messages to the block edges, and all blocks are finished at once.

Training takes at most ``most_rows`` rows for each language, drawn by a hash of the id, and their first
``most_words`` words each; the driver holds those texts and nothing else. Prediction reads whole texts.

A null text, or one without a letter, is ``und`` with score 0; so is every text where there was nothing to learn from.
Rows with a null language are not learned from. Rows that repeat get the same answer. An empty table gives an empty
result. Other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.llm.common import hash_63, last_drawn, ship, slices
from linetally.llm.words import Words, mixed

MOST_ROWS = 400
MOST_WORDS = 2_000
STEP = 2 << 20
BLOCK = 128
BUCKETS = 1 << 16
UNKNOWN = "und"
#: Letters of words: ASCII letters and whatever lies beyond ASCII.
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def word_features(words: Words, which: np.ndarray, lexicon: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the words ``which``, one word after another, and each word's offset in them."""
    size = words.end[which] - words.begin[which]
    wide = size + 2
    at = np.concatenate([[0], np.cumsum(wide)])
    flat = np.zeros(at[-1] + 4, np.uint32)
    inner = np.ones(at[-1], bool)
    inner[at[:-1]] = inner[at[1:] - 1] = False
    source = np.repeat(words.begin[which] - at[:-1] - 1, wide) + np.arange(at[-1])
    flat[:-4][inner] = words.data[source[inner]]
    flat[at[:-1]] = 1  # the edges
    flat[at[1:] - 1] = 2
    left = np.repeat(at[1:], wide) - np.arange(at[-1])  # bytes from here to the word's end
    two = flat[:-4] << np.uint32(8) | flat[1:-3]
    three = two << np.uint32(8) | flat[2:-2]
    four = three << np.uint32(8) | flat[3:-1]
    known = np.searchsorted(lexicon, hashes[which])
    known = np.where(lexicon[np.minimum(known, len(lexicon) - 1)] == hashes[which], known, -1) if len(lexicon) else np.full(len(which), -1)
    columns = []
    for n, codes in ((2, two), (3, three), (4, four)):
        number = (mixed(codes.astype(np.uint64) + np.uint64(n << 40)) >> np.uint64(48)).astype(np.int64)
        columns.append(np.where(left >= n, number, -1))
    grid = np.stack(columns, 1)
    # the lexicon's number stands where the first edge would begin a fourth feature
    extra = np.full(at[-1], -1)
    extra[at[:-1]] = np.where(known >= 0, known + BUCKETS, -1)
    grid = np.concatenate([grid, extra[:, None]], 1)
    keep = grid >= 0
    per_word = np.add.reduceat(keep.sum(1), at[:-1]) if len(which) else np.zeros(0, np.int64)
    return grid[keep], np.concatenate([[0], np.cumsum(per_word)]).astype(np.int64)


@dataclass
class Crf:
    languages: list[str]
    lexicon: np.ndarray
    weights: np.ndarray  # features x languages
    moves: np.ndarray  # log weights of transitions
    start: np.ndarray

    def emissions(self, words: Words) -> np.ndarray:
        """Log weight of each language for each word; equal words are computed once."""
        h = words.hashes()
        _, one, back = np.unique(h, return_index=True, return_inverse=True)
        numbers, at = word_features(words, one, self.lexicon, h)
        total = np.add.reduceat(self.weights[numbers], at[:-1], axis=0) if len(one) else np.zeros((0, len(self.languages)))
        return total[back]


def posteriors(e: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Probabilities of the states of all words. ``e``: log weights (words x states), ``first``: each text's first word."""
    n, k = e.shape
    size = np.diff(first)
    texts = np.flatnonzero(size)
    if not n:
        return e
    w = np.exp(e - e.max(1, keepdims=True)).astype(np.float64)
    per_text = -(-size[texts] // block)
    of = np.repeat(np.arange(len(texts)), per_text)
    number = np.arange(len(of)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = first[texts][of] + number * block
    length = np.minimum(first[texts + 1][of] - begin, block)
    order = np.argsort(-length, kind="stable")  # lanes that end early come last
    begin, length, of, number = begin[order], length[order], of[order], number[order]
    live = [int(np.searchsorted(-length, -t, "left")) for t in range(block)]  # lanes with more than t words
    lanes, t_matrix = len(begin), np.exp(moves - moves.max())
    opening = number == 0

    transfer = np.tile(np.eye(k), (lanes, 1, 1))
    for t in range(block):
        m = live[t]
        if not m:
            break
        x = transfer[:m]
        moved = x @ t_matrix
        if t == 0:
            moved[opening[:m]] = x[opening[:m]]
        moved *= w[begin[:m] + t][:, None, :]
        if t % 4 == 3:
            moved /= moved.max((1, 2), keepdims=True)
        transfer[:m] = moved
    transfer /= transfer.max((1, 2), keepdims=True)

    into, out = np.zeros((lanes, k)), np.ones((lanes, k))
    by_number: dict[int, np.ndarray] = {}
    last = int(number.max())
    lane_of = np.full((len(texts), last + 1), -1, np.int32) if len(texts) * (last + 1) < 1 << 24 else None
    if lane_of is not None:
        lane_of[of, number] = np.arange(lanes)
        by_number = {j: lane_of[:, j][lane_of[:, j] >= 0] for j in range(last + 1)}
    else:
        chain = np.lexsort((of, number))
        cuts = np.searchsorted(number[chain], np.arange(last + 2))
        by_number = {j: chain[cuts[j] : cuts[j + 1]] for j in range(last + 1)}
    into[opening] = np.exp(start - start.max())
    for j in range(last):  # forward over blocks
        here, there = by_number[j], by_number[j + 1]
        here = here[np.isin(of[here], of[there])]
        here, there = here[np.argsort(of[here])], there[np.argsort(of[there])]
        x = np.einsum("lk,lkm->lm", into[here], transfer[here])
        into[there] = x / x.sum(1, keepdims=True)
    for j in range(last, 0, -1):  # backward
        here, there = by_number[j], by_number[j - 1]
        there = there[np.isin(of[there], of[here])]
        here, there = here[np.argsort(of[here])], there[np.argsort(of[there])]
        x = np.einsum("lkm,lm->lk", transfer[here], out[here])
        out[there] = x / x.sum(1, keepdims=True)

    p = np.empty((n, k))
    a = into
    for t in range(block):
        m = live[t]
        if not m:
            break
        x = a[:m] @ t_matrix
        if t == 0:
            x[opening[:m]] = a[:m][opening[:m]]
        x *= w[begin[:m] + t]
        x /= x.sum(1, keepdims=True)
        p[begin[:m] + t] = x
        a = x
    b = out.copy()
    for t in range(block - 1, -1, -1):
        m = live[t]
        if not m:
            continue
        i = begin[:m] + t
        x = p[i] * b[:m]
        p[i] = x / x.sum(1, keepdims=True)
        b[:m] = (b[:m] * w[i]) @ t_matrix.T
        b[:m] /= b[:m].sum(1, keepdims=True)
    return p


def fit(texts: list[str], langs: list[str], rounds: int = 150, lanes: int = 192, length: int = 48, seed: int = 5) -> Crf | None:
    """Learn from whole texts of one language each."""
    languages = sorted(set(langs))
    if not languages:
        return None
    k = len(languages)
    words = Words.of(pa.array(texts, pa.large_string()), _LETTER)
    if not len(words.begin):
        return None
    state = np.array([languages.index(x) for x in langs])[words.doc]
    h = words.hashes()
    lexicon, times = np.unique(h, return_counts=True)
    lexicon = lexicon[times >= 8]
    distinct, one, back = np.unique(h, return_index=True, return_inverse=True)
    numbers, at = word_features(words, one, lexicon, h)
    model = Crf(languages, lexicon, np.zeros((BUCKETS + len(lexicon), k), np.float32), np.zeros((k, k)), np.zeros(k))
    rng = np.random.default_rng(seed)
    by_state = [np.flatnonzero(state == s) for s in range(k)]
    square = [np.full(x.shape, 1e-6) for x in (model.weights, model.moves, model.start)]
    for _ in range(rounds):
        # runs of one language, of random length, put together
        y = np.empty((lanes, length), np.int64)
        y[:, 0] = rng.integers(0, k, lanes)
        for t in range(1, length):
            switch = rng.random(lanes) < 0.06
            y[:, t] = np.where(switch, rng.integers(0, k, lanes), y[:, t - 1])
        word = np.empty((lanes, length), np.int64)
        for s in range(k):
            mask = y == s
            begin = rng.integers(0, len(by_state[s]), lanes)[:, None] + np.arange(length)
            word[mask] = by_state[s][begin % len(by_state[s])][mask]
        kind = back[word]  # distinct word
        used, where = np.unique(kind, return_inverse=True)
        where = where.reshape(kind.shape)
        count = at[used + 1] - at[used]
        offsets = np.concatenate([[0], np.cumsum(count)])
        flat = numbers[np.repeat(at[used] - offsets[:-1], count) + np.arange(offsets[-1])]
        e = np.add.reduceat(model.weights[flat], offsets[:-1], axis=0)[where].astype(np.float64)
        # forward-backward over all lanes
        em = np.exp(e - e.max(2, keepdims=True))
        move = np.exp(model.moves)
        a, c = np.empty_like(em), np.empty((lanes, length))
        for t in range(length):
            x = (np.exp(model.start) if t == 0 else a[:, t - 1] @ move) * em[:, t]
            c[:, t] = x.sum(1)
            a[:, t] = x / c[:, t : t + 1]
        b, pair = np.ones((lanes, k)), np.zeros((k, k))
        p = np.empty_like(a)
        p[:, -1] = a[:, -1]
        for t in range(length - 2, -1, -1):
            x = b * em[:, t + 1] / c[:, t + 1 : t + 2]
            pair += (a[:, t].T @ x) * move
            b = x @ move.T
            p[:, t] = a[:, t] * b
        wish = np.eye(k)[y]
        d = (wish - p).reshape(-1, k)
        per_word = np.stack([np.bincount(where.ravel(), d[:, s], len(used)) for s in range(k)], 1)
        g = np.zeros(model.weights.shape)
        spread = np.repeat(per_word, count, axis=0)
        for s in range(k):
            g[:, s] = np.bincount(flat, spread[:, s], len(g))
        seen = np.zeros((k, k))
        np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        steps = (g / lanes, (seen - pair) / lanes, (wish[:, 0] - p[:, 0]).sum(0) / lanes)
        for x, step, q, rate in zip((model.weights, model.moves, model.start), steps, square, (0.08, 0.05, 0.05), strict=True):
            q += step * step
            x += rate * step / np.sqrt(q)
    return model


def trained(docs: DataFrame, learns: Column, most_rows: int = MOST_ROWS, most_words: int = MOST_WORDS) -> Crf | None:
    """Fit on the rows of ``docs`` (doc_id, text, lang) for which ``learns`` holds."""
    ship(docs.sparkSession)
    usable = docs.where(learns).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return None
    last = F.create_map(*[x for lang, n in sorted(counts.items()) for x in (F.lit(lang), F.lit(last_drawn(most_rows, n)).cast("long"))])
    drawn = usable.where(hash_63("doc_id", F.length("text")) <= last[F.col("lang")])
    part = F.array_join(F.slice(F.split("text", " "), 1, most_words), " ")
    rows = drawn.select(part.alias("text"), "lang").toPandas().sort_values(["lang", "text"])
    return fit(rows["text"].tolist(), rows["lang"].tolist())


def predicted(docs: DataFrame, model: Crf | None, id_column: str = "doc_id", text_column: str = "text", with_spans: bool = True) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, n_words, and the runs of words in one language (``spans``)."""
    ship(docs.sparkSession)
    schema = "doc_id long, lang_pred string, score double, n_words long, spans array<struct<first_word: long, last_word: long, lang: string>>"
    span = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("lang", pa.string())]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", STEP):
                words = Words.of(part.column(1), _LETTER)
                n = part.num_rows
                count = np.diff(words.first)
                langs, scores, spans = [UNKNOWN] * n, np.zeros(n), [[] for _ in range(n)]
                if model is not None and len(words.begin):
                    p = posteriors(model.emissions(words), words.first, model.moves, model.start)
                    texts = np.flatnonzero(count)
                    sums = np.add.reduceat(p, words.first[texts], axis=0)
                    best = sums.argmax(1)
                    mean = np.clip(sums[np.arange(len(texts)), best] / count[texts], 0, 1)
                    state = p.argmax(1) if with_spans else None
                    for i, s, m in zip(texts.tolist(), best.tolist(), mean.tolist(), strict=True):
                        a, b = words.first[i], words.first[i + 1]
                        # words made of marks beyond ASCII hold no letter
                        if words.data[words.text_at[i] : words.text_at[i + 1]].max() >= 128 and not any(c.isalpha() for c in part.column(1)[i].as_py()):
                            continue
                        langs[i], scores[i] = model.languages[s], m
                        if with_spans:
                            cuts = [0, *(np.flatnonzero(np.diff(state[a:b])) + 1).tolist(), int(b - a)]
                            spans[i] = [{"first_word": x, "last_word": y - 1, "lang": model.languages[state[a + x]]} for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(langs, pa.string()), pa.array(scores), pa.array(count, pa.int64()), pa.array(spans, span)],
                    ["doc_id", "lang_pred", "score", "n_words", "spans"],
                )

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(predict, schema)
