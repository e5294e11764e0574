"""Benchmark decontamination by spaced-seed hashing, on built-in expressions only.

Words are runs of letters and digits, in lower case; in scripts without blanks each letter is one. A seed is a mask over consecutive words: at each position the
words under the mask's ones are hashed and the others ignored, so a substituted word breaks only the seeds that look at
it. Seeds of the benchmark's items are joined with the seeds at every position of every text (three masks each). A
common seed puts an item on a diagonal of a text: its first word would stand at that place.

Each diagonal is then verified on the words themselves: along the item, an equal word counts +1 and another -2, and the
best stretch of the diagonal must reach 12, or 0.6 times the item's words if that is less. Substitutions around the
hit are tolerated, chance seeds are not. Hashes only nominate, so they cannot make a false overlap.

Texts are never shuffled in the first pass: positions are narrow rows that meet the seeds of the benchmark in their own
task (broadcast up to ``most_seeds``; beyond it both sides are shuffled by seed). Hits are kept per text hash, so copies
share them, and meet the texts again by that hash (broadcast up to ``most_hits`` texts with hits, shuffled beyond).

Null and empty texts and items overlap with nothing. An item with fewer words than the longest mask spans (12) is found
if ``short_items`` is given, and only whole: one more mask for each such number of words looks at all of them, and all
have to be equal. Without it such an item is no evidence. Rows that repeat, or share an id, are judged each for itself; so are
items. Empty tables give empty results. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.env import written
from linetally.llm.common import fresh, sized_join, whole_text

MASKS = ("110110011011", "11101011011", "101110110111")
SPAN = max(map(len, MASKS))
LEAST_SCORE = 12
LEAST_SHARE = 0.6
MISMATCH = 2
#: What is broadcast at most: rows of 30 bytes, and rows of some hundred.
MOST_SEEDS = 1_000_000
MOST_HITS = 200_000


#: Thai, Lao, Burmese, Khmer, kana and Han: words are not set apart by blanks.
_UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uFF66-\uFF9F\x{20000}-\x{3FFFF}"
_WORDS = r"([\p{L}\p{N}]+)"
_MIXED_WORDS = rf"([{_UNSPACED}&&[\p{{L}}\p{{N}}]]|[\p{{L}}\p{{N}}&&[^{_UNSPACED}]]+)"


def words_of(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.rlike(f"[{_UNSPACED}]"), F.regexp_extract_all(low, F.lit(_MIXED_WORDS), F.lit(1))).otherwise(F.regexp_extract_all(low, F.lit(_WORDS), F.lit(1)))


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is read."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _seeds(text: Column, masks: tuple[str, ...]) -> Column:
    """Seeds of all positions, mask after mask; places past the end hash fewer words and equal no seed of an item."""

    def under(mask: str, h: Column) -> Column:
        looks = [o for o, bit in enumerate(mask) if bit == "1" and o]
        return F.transform(h, lambda x, i: F.xxhash64(F.lit(mask), x, *[F.get(h, i + o) for o in looks]))

    hashes = F.transform(words_of(text), lambda w: F.xxhash64(w))
    return _once(hashes, lambda h: F.concat(*[under(m, h) for m in masks]))


def _positions(rows: DataFrame, keys: list[str], masks: tuple[str, ...] = MASKS) -> DataFrame:
    """One row per seed: the keys, the seed, its mask and place, and the number of words."""
    seeds = rows.select(*keys, _seeds(F.col("text"), masks).alias("seeds"))
    seeds = seeds.select(*keys, (F.size("seeds") / len(masks)).cast("int").alias("n"), F.posexplode("seeds").alias("at", "seed"))
    return seeds


def item_seeds(benchmark: DataFrame, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """Seeds of the items, only those that look at whole masks: seed, item (number), place. Masks without a gap are for
    the items of just as many words."""
    at = F.col("at") % F.col("n")
    mask = (F.col("at") / F.col("n")).cast("int")
    span = F.element_at(F.array(*[F.lit(len(m)) for m in masks]), mask + 1)
    whole = mask >= len(MASKS)
    rows = _positions(benchmark, ["item"], masks).where((whole & (span == F.col("n"))) | (~whole & (F.col("n") >= SPAN)))
    return rows.where(at + span <= F.col("n")).select("seed", "item", at.alias("place"))


def _verified(text: Column, hits: Column) -> Column:
    """For each item hit in a text the best stretch over its diagonals, where it suffices."""

    def stretch(dw: Column, iw: Column, d: Column) -> Column:
        """Best run along one diagonal: score, and the item's words equal and looked at in it."""
        equal = F.transform(iw, lambda w, j: F.coalesce(F.get(dw, d + j) == w, F.lit(False)))
        zero = F.lit(0)
        start = F.struct(*[zero.alias(x) for x in ("run", "same", "first", "score", "equal", "from", "to", "j")])

        def step(s: Column, e: Column) -> Column:
            fresh_run = s["run"] <= 0
            run = F.when(fresh_run, 0).otherwise(s["run"]) + F.when(e, 1).otherwise(-MISMATCH)
            same = F.when(fresh_run, 0).otherwise(s["same"]) + F.when(e, 1).otherwise(0)
            first = F.when(fresh_run, s["j"]).otherwise(s["first"])
            better = run > s["score"]
            return F.struct(
                run.alias("run"), same.alias("same"), first.alias("first"),
                F.when(better, run).otherwise(s["score"]).alias("score"),
                F.when(better, same).otherwise(s["equal"]).alias("equal"),
                F.when(better, first).otherwise(s["from"]).alias("from"),
                F.when(better, s["j"] + 1).otherwise(s["to"]).alias("to"),
                (s["j"] + 1).alias("j"),
            )

        return F.aggregate(equal, start, step, lambda s: F.struct(s["score"].alias("score"), (-(d + s["from"])).alias("back"), s["equal"].alias("equal"), (s["to"] - s["from"]).alias("length")))

    def item(dw: Column, x: Column) -> Column:
        best = F.array_max(F.transform(x["diagonals"], lambda d: stretch(dw, x["words"], d)))
        return _once(
            best,
            lambda b: F.struct(
                x["item_id"].alias("item_id"), F.size(x["words"]).alias("item_words"), (-b["back"]).alias("first_word"),
                b["length"].alias("n_words"), b["equal"].alias("n_equal"), b["score"].alias("score"),
            ),
        )

    found = _once(words_of(text), lambda dw: F.transform(hits, lambda x: item(dw, x)))
    long_need = lambda x: F.least(F.lit(LEAST_SCORE), F.ceil(F.lit(LEAST_SHARE) * x["item_words"]))
    need = lambda x: F.when(x["item_words"] < SPAN, x["item_words"]).otherwise(long_need(x))
    return F.when(hits.isNotNull(), F.filter(found, lambda x: x["score"] >= need(x)))


def _whole_masks(items: DataFrame) -> tuple[str, ...]:
    """A mask without a gap for each number of words that items under 12 words have."""
    n = F.size(words_of(F.col("text")))
    found = items.select(n.alias("n")).where(F.col("n").between(1, SPAN - 1)).distinct().collect()  # 11 rows at most
    return tuple("1" * n for n in sorted(r["n"] for r in found))


def with_overlaps(
    docs: DataFrame, benchmark: DataFrame, overlaps: str, text_column: str = "text", most_seeds: int = MOST_SEEDS, most_hits: int = MOST_HITS,
    short_items: bool = False,
) -> DataFrame:
    """``docs`` with one more column: the items found in each text (null or empty: none), as an array of struct
    (item_id, item_words, first_word in the text, n_words looked at, n_equal, score). ``benchmark``: item_id, text."""
    items = written(benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", whole_text("text").alias("text")), "bench-items")
    masks = MASKS + (_whole_masks(items) if short_items else ())
    seeds = written(item_seeds(items, masks), "bench-seeds")
    text = whole_text(text_column)
    positions = _positions(docs.select(F.xxhash64(text).alias("key"), text.alias("text")), ["key"], masks)
    met = sized_join(positions, seeds, "seed", "inner", seeds.count(), most_seeds)
    diagonals = met.select("key", "item", (F.col("at") % F.col("n") - F.col("place")).alias("diagonal")).distinct()
    words = items.select("item", "item_id", words_of(F.col("text")).alias("words"))
    by_item = diagonals.groupBy("key", "item").agg(F.collect_list("diagonal").alias("diagonals"))
    by_item = sized_join(by_item, words, "item", "inner", items.count(), most_hits)
    hits = written(by_item.groupBy("key").agg(F.collect_list(F.struct("item_id", "words", "diagonals")).alias("hits")), "bench-hits")
    key, hit = fresh(docs.columns, "__key", "__hits")
    joined = sized_join(docs.withColumn(key, F.xxhash64(text)), hits.select(F.col("key").alias(key), F.col("hits").alias(hit)), key, "left", hits.count(), most_hits)
    return joined.withColumn(overlaps, _verified(text, F.col(hit))).select(*docs.columns, overlaps)


def leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", short_items: bool = False) -> DataFrame:
    """One row per document and benchmark item found in it, at its best place."""
    found = with_overlaps(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), benchmark, "found", short_items=short_items)
    return found.where(F.size("found") > 0).select("doc_id", F.explode("found").alias("x")).select("doc_id", "x.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", short_items: bool = False) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found."""
    (found,) = fresh(docs.columns, "__found")
    return with_overlaps(docs, benchmark, found, text_column, short_items=short_items).where(F.coalesce(F.size(found), F.lit(0)) <= 0).select(*docs.columns)
