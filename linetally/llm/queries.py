"""The operators over the test tables, and the same in SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.llm import decontaminate, exact_dedup, jaccard_join, language, licenses, main_text, manifest, packing, pseudonyms, quality, repeats, spelling, token_files
from linetally.llm.common import held_out, learns, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

#: Stands in for a secret that a user keeps elsewhere.
DEMO_KEY = "not a secret: only for the test tables"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@_query
def op1_spaced_seed_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, substitutions tolerated."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)


@_query
def op2_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from two thirds of the documents."""
    docs = table(spark, sf_dir, "documents")
    model = language.trained(docs, learns("doc_id", 3, 1))
    found = language.predicted(docs, model, with_spans=False)
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score", "n_words")


@_query
def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal values replaced, and how many of each kind."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pseudonyms.pseudonymised(docs, DEMO_KEY)
    return found.select("doc_id", "text", *[F.col("pii_found")[k].alias(f"n_{k}") for k in pseudonyms.KINDS])


@_query
def op4_context_mixing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written in order by the range coder and read back."""
    return token_files.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE).drop("ids")


@_query
def op5_partition_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by a similarity of 3/4 of their 5-word shingles."""
    return jaccard_join.similar(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@_query
def op6_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents without those of 50-byte strings that start in a document with a smaller id."""
    return repeats.without_repeats(table(spark, sf_dir, "documents"), with_kept=False).drop("kept", "removed")


@_query
def op7_minimum_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), WORD_BPE, with_ids=False).drop("ids")


@_query
def op8_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learned from four fifths of the documents."""
    docs = table(spark, sf_dir, "documents")
    model, _ = quality.trained(docs, table(spark, sf_dir, "labels"), learns("doc_id", 5, 0))
    score = F.col("score")
    return quality.scored(docs, model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", F.when(score >= 0.3, 1).otherwise(0).alias("predicted")
    )


@_query
def op9_two_pass_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of whole texts; the row with the largest id stays."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op9_two_pass_bloom_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


@_query
def op10_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and lines that meet a license template."""
    found = licenses.license_scan(table(spark, sf_dir, "documents"))
    return found.withColumn("n_blocks", F.size("blocks").cast("long")).drop("blocks")


_LETTERS = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
ORACLES["op10_license_templates"] = f"""
WITH templates AS (
  SELECT list_distinct(string_split(t, ' ')) AS need, label
  FROM (VALUES {", ".join(f"('{t}', '{label}')" for t, label in licenses.TEMPLATES)}) AS x(t, label)
), phrases AS (
  SELECT string_split(p, ' ') AS phrase, label
  FROM (VALUES {", ".join(f"('{p}', '{label}')" for p, label in licenses.PHRASES)}) AS x(p, label)
), texts AS (
  SELECT doc_id, regexp_extract_all({_LETTERS}, {_WORD}) AS words FROM documents
), lines AS (
  SELECT doc_id, list_distinct(regexp_extract_all(line, {_WORD})) AS words
  FROM (SELECT doc_id, unnest(string_split({_LETTERS}, chr(10))) AS line FROM documents)
), met AS (
  SELECT doc_id, label, len(list_intersect(words, need)) / len(need) AS share
  FROM lines, templates
  WHERE len(list_intersect(words, need)) >= ceil({licenses.THRESHOLD} * len(need) - 1e-9)
), blocks AS (
  SELECT doc_id, list(label) AS labels, max(share) AS share, count(*) AS n_blocks FROM met GROUP BY doc_id
), places AS (
  SELECT doc_id, label, unnest(list_filter(range(1, len(words) + 1), lambda i: words[i : i + len(phrase) - 1] = phrase)) - 1 AS place
  FROM texts, phrases
), base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(label) AS labels FROM places GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(list_sort(list_distinct(coalesce(base.labels, []))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(blocks.labels, [])))), ',') AS labels,
       greatest(CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, coalesce(share, 0.0)) AS score,
       coalesce(n_blocks, 0) AS n_blocks
FROM texts LEFT JOIN base USING (doc_id) LEFT JOIN blocks USING (doc_id)
"""


ORACLES["op5_partition_jaccard"] = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({_LETTERS}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) >= 5
           THEN list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' ')))
           WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles
  FROM texts
), members AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, len(s.shingles) AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reached r USING (doc_id) GROUP BY s.doc_id, s.shingles
"""

ORACLES["op6_suffix_repeats"] = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents
), places AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS w FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM texts)
), hits AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY w) AS first FROM places) WHERE first < doc_id
), opened AS (
  SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50, true) AS opens FROM hits
), runs AS (
  SELECT doc_id, min(p) AS a, max(p) + 50 AS b
  FROM (SELECT doc_id, p, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM opened) GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS h,
         sum(b - a) AS n_removed, count(*) AS n_spans
  FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT t.doc_id, len(t.h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.h, t.h))) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
"""


@_query
def op11_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return main_text.main_text(table(spark, sf_dir, "pages"))


@_query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, their spelling variants and forms; one run in 31 loses a code point first."""
    return spelling.variants(table(spark, sf_dir, "documents"), noise=spelling.NOISE)


@_query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, roots and proofs of all documents; a fifth of them is checked with its capitals lost."""
    docs = table(spark, sf_dir, "documents")
    lost = F.translate("text", ascii_uppercase, ascii_lowercase)
    probe = manifest.row_digest(*[lost if f == "text" else F.col(f) for f in manifest.FIELDS])
    return manifest.manifest(docs, F.when(held_out("doc_id", 5, 0), probe))


#: Unsigned crc32 of a list of bytes; ``crc_table`` has one row, the table of the 256 remainders.
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS remainders
)"""
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, len({hex}), 2),
  lambda k: ('0x' || substr({hex}, k + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])))"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({value}::VARCHAR)) || ':' || {value} END"


def _tree(name: str, rows: str, levels: int) -> str:
    """CTEs that fold ``rows`` (tree, k from 0, digest, proof, nodes) level by level; ``name`` holds what remains."""
    parts = [f"{name}0 AS ({rows})"]
    for level in range(levels):
        below = f"{name}{level}"
        parts.append(f"""{name}{level}up AS (
  SELECT tree, k // 16 AS k, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY k)) ELSE any_value(digest) END AS digest
  FROM {below} GROUP BY tree, k // 16
), {name}{level + 1} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{level}up), {name}{level}beside AS (
  SELECT a.tree, a.k, coalesce(string_agg(b.digest, '' ORDER BY b.k), '') AS beside
  FROM {below} a LEFT JOIN {below} b ON a.tree = b.tree AND a.k // 16 = b.k // 16 AND a.k <> b.k GROUP BY a.tree, a.k
)""")
    return ", ".join(parts)


#: Levels of the oracle: sources of up to 16 ** 4 rows, up to 16 ** 2 sources.
_HIGH, _WIDE = 4, 2
_FOLD = """{name}fold{level} AS (
  SELECT f.* EXCLUDE (folded), CASE WHEN b.beside = '' AND u.n = 1 THEN folded ELSE
         sha256(substr(b.beside, 1, 64 * (place // {size} % 16)) || folded || substr(b.beside, 64 * (place // {size} % 16) + 1)) END AS folded
  FROM {before} f JOIN {name}{level}beside b ON b.tree = f.{tree} AND b.k = f.{place} // {size}
  JOIN {name}{level} u ON u.tree = b.tree AND u.k = b.k
)"""


def _folds(name: str, levels: int, before: str, tree: str, place: str) -> tuple[str, str]:
    parts = []
    for level in range(levels):
        parts.append(_FOLD.replace("(place //", f"({place} //").format(name=name, level=level, size=16**level, before=before, tree=tree, place=place))
        before = f"{name}fold{level}"
    return ", ".join(parts), before


_UP, _LAST = _folds("node", _HIGH, "started", "tree", "place")
_OVER, _DONE = _folds("source", _WIDE, _LAST, "top", "source_place")
_SIDES = [("node", i, "tree", "place") for i in range(_HIGH)] + [("source", i, "top", "source_place") for i in range(_WIDE)]
ORACLES["op13_merkle_manifest"] = f"""
WITH {_CRC_TABLE}, leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256(concat({", ".join(_field(f) for f in manifest.FIELDS)})) AS leaf,
         CASE WHEN {_CRC.format(hex="hex(encode(doc_id::VARCHAR))")} % 5 = 0
              THEN sha256(concat({", ".join(_field(f if f != "text" else "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") for f in manifest.FIELDS)})) END AS probe
  FROM documents, crc_table
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), {_tree("node", "SELECT tree, place AS k, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM numbered", _HIGH)}
, {_tree("source", f"SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS k, digest, count(*) OVER () AS n FROM node{_HIGH}", _WIDE)}
, subroots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS source_place FROM node{_HIGH}
), started AS (
  SELECT n.*, s.subroot, s.source_place, '' AS top, coalesce(probe, leaf) AS folded FROM numbered n JOIN subroots s USING (tree)
), {_UP}, {_OVER}
SELECT doc_id, leaf, subroot, (SELECT any_value(digest) FROM source{_WIDE}) AS root,
       sha256({" || ".join(f"b{j}.beside" for j in range(len(_SIDES)))}) AS proof_sha256, folded AS folded_root,
       folded = (SELECT any_value(digest) FROM source{_WIDE}) AS verified
FROM {_DONE} f
{" ".join(f"JOIN {name}{i}beside b{j} ON b{j}.tree = f.{tree} AND b{j}.k = f.{place} // {16**i}" for j, (name, i, tree, place) in enumerate(_SIDES))}
"""


ORACLES["op12_spelling_variants"] = f"""
WITH RECURSIVE {_CRC_TABLE}, runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {spelling.LEAST_LENGTH} GROUP BY ALL
), hashed AS (
  SELECT run, times, {_CRC.format(hex="h")} AS crc
  FROM (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs), crc_table
), noisy AS (
  SELECT times, CASE WHEN crc % {spelling.NOISE} = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word
  FROM hashed
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM noisy
  WHERE length(word) >= {spelling.LEAST_LENGTH} GROUP BY word HAVING sum(times) >= {spelling.LEAST_COUNT}
), cuts AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS cut FROM (SELECT *, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS top_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= {spelling.TIMES} * w.n THEN top_n END AS form_n,
         CASE WHEN top_n >= {spelling.TIMES} * w.n THEN (SELECT min(other) FROM near x WHERE x.word = w.word AND x.other_n = top_n) END AS form
  FROM words w LEFT JOIN best USING (word)
), ways AS (
  SELECT word, form AS at FROM forms WHERE form IS NOT NULL
  UNION ALL
  SELECT ways.word, forms.form FROM ways JOIN forms ON forms.word = ways.at WHERE forms.form IS NOT NULL
)
SELECT f.word, f.form, coalesce(r.at, f.word) AS root, f.n, f.n_near, f.form_n
FROM forms f LEFT JOIN (
  SELECT ways.word, ways.at FROM ways JOIN forms ON forms.word = ways.at WHERE forms.form IS NULL
) r ON r.word = f.word
"""


_MASKED = " UNION ALL ".join(
    f"SELECT {{keys}}, i, '{m}' || ' ' || array_to_string([{', '.join(f'words[i + {o + 1}]' for o, bit in enumerate(m) if bit == '1')}], ' ') AS seed "
    f"FROM (SELECT {{keys}}, words, unnest(range(0, len(words) - {len(m) - 1})) AS i FROM {{rows}})"
    for m in decontaminate.MASKS
)
ORACLES["op1_spaced_seed_leaks"] = f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS words FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS words FROM benchmark
), usable AS (
  SELECT * FROM items WHERE len(words) >= {decontaminate.SPAN}
), item_seeds AS ({_MASKED.format(keys="item_id", rows="usable")}),
text_seeds AS ({_MASKED.format(keys="doc_id", rows="texts")}),
diagonals AS (
  SELECT DISTINCT t.doc_id, s.item_id, t.i - s.i AS d FROM text_seeds t JOIN item_seeds s USING (seed)
), steps AS (
  SELECT doc_id, item_id, d, j, coalesce(d + j >= 0 AND t.words[d + j + 1] = u.words[j + 1], false) AS same
  FROM (SELECT doc_id, item_id, d, words, unnest(range(0, len(words))) AS j FROM diagonals JOIN usable USING (item_id)) x
  JOIN usable u USING (item_id) JOIN texts t USING (doc_id)
), totals AS (
  SELECT doc_id, item_id, d, j,
         sum(CASE WHEN same THEN 1 ELSE -{decontaminate.MISMATCH} END) OVER w AS total, sum(same::INT) OVER w AS n_same
  FROM steps WINDOW w AS (PARTITION BY doc_id, item_id, d ORDER BY j)
  UNION ALL SELECT doc_id, item_id, d, -1, 0, 0 FROM diagonals
), stretches AS (
  SELECT b.doc_id, b.item_id, b.d, a.j + 1 AS first, b.j - a.j AS length, b.total - a.total AS score, b.n_same - a.n_same AS n_equal, b.j
  FROM totals a JOIN totals b ON a.doc_id = b.doc_id AND a.item_id = b.item_id AND a.d = b.d AND a.j < b.j
), found AS (
  -- per diagonal the first end with the best score, begun as late as possible; of diagonals the best, the first in the text
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY score DESC, d + first, n_equal DESC, length DESC) AS place
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id, d ORDER BY score DESC, j, first DESC) AS own FROM stretches)
  WHERE own = 1
)
SELECT doc_id, item_id, len(words)::INT AS item_words, (d + first)::INT AS first_word, length::INT AS n_words, n_equal::INT AS n_equal,
       score::INT AS score
FROM found JOIN usable USING (item_id)
WHERE place = 1 AND score >= least({decontaminate.LEAST_SCORE}, ceil({decontaminate.LEAST_SHARE} * len(words)))
"""
