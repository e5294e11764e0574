"""Main text of web pages by site style trees.

The pages of a host are merged into one tree of element nodes. An element node is known by its tag and names, its place
among its siblings, the style of its parent (the sequence of the children's tags and names, repeats as one) and its
parent. Of every node we count how often each of its own styles occurs (presentation), and in how many pages each of its
texts stands (content). Both are rows keyed by node, so a host of any size is spread over tasks, and a host with a third of
all pages is folded before the shuffle. Copies of a page count once.

* Presentation: the entropy of a node's styles, from 0 (always the same) to 1 (never the same).
* Content: one minus the entropy of a text over the pages: 1 if it stands in one page, 0 if it stands in all.
* A branch: ``(1 - DECAY ** styles) * presentation + DECAY ** styles * mean of what is below``, as importance of composite
  nodes is defined, for each branch as it stands in the page.

A host with few pages tells little, so importance is mixed with what the page itself shows (link share, length of blocks,
sentences), the more so the fewer pages there are. Branches under ``LEAST_IMPORTANCE`` go. Branches named as something
other than the article go as well (menus, headers, footers, sidebars, notices, adverts, forms, reader comments), since
comments, say, differ on every page; so does what stands outside a marked article that holds a good part of the page.

Rows: null or empty pages, and pages of markup alone, have an empty text. A null url is a host of its own. Repeated rows
come out each. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from linetally.env import written
from linetally.llm.common import ship, slices, whole_text
from linetally.llm.dom import Page, parsed

DECAY = 0.9
LEAST_IMPORTANCE = 0.35
#: So many other pages of the host weigh as much as the page's own looks.
TRUST = 8
#: A marked article with this share of the page's text is the article.
ARTICLE_SHARE = 0.25
#: Bytes of pages held by a task at once.
STEP = 1 << 20

# Elements, roles and words in names that mark what is not the article.
OTHER_TAGS = frozenset(
    "nav footer aside form menu dialog select button fieldset template svg canvas audio video object applet datalist optgroup option map "
    "frameset".split()
)
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist status".split())
OTHER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot adbox adsbygoogle sponsor sponsored sponsors promo promos promotion sidebar "
    "sidenav menu menus submenu nav navbar navigation navi breadcrumb breadcrumbs cookie cookies consent gdpr notice notices notification popup "
    "modal overlay newsletter subscribe subscription signup signin login share sharing shares social comment comments commentlist reply "
    "replies respond disqus discussion related recommended recommendations footer masthead toolbar pagination pager widget widgets copyright "
    "banner banners trending skip searchbox searchform paywall".split()
)
HEADER_NAMES = frozenset("header topbar".split())
MAIN_TAGS = frozenset("article main".split())
PROSE_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dl dt dd table tbody thead tfoot tr td th caption figure figcaption ul ol li".split())
LIST_TAGS = frozenset("ul ol li".split())

_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_DIGITS = re.compile(r"\d+")
_SENTENCE = re.compile(r"[.!?…。！？:;,][\"'”’)»]*(?:\s|$)")

NODES = "key long, styles array<struct<id: bigint, style: bigint, n: bigint, pages: bigint>>, texts array<struct<id: bigint, text: bigint>>"
_NODES = pa.schema([
    ("key", pa.int64()),
    ("styles", pa.list_(pa.struct([(c, pa.int64()) for c in ("id", "style", "n", "pages")]))),
    ("texts", pa.list_(pa.struct([("id", pa.int64()), ("text", pa.int64())]))),
])


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) or 1


def _label(page: Page, e: int) -> str:
    names = page.elements[e].names
    return _DIGITS.sub("0", f"{page.elements[e].tag}.{names.get('class', '')}#{names.get('id', '')}")


def node_ids(page: Page, host: str) -> tuple[list[int], list[int]]:
    """For every element the id of its node in the host's tree, and its style (0 if it holds no element)."""
    ids, styles = [0] * len(page.elements), [0] * len(page.elements)
    ids[0] = _hash(f"//{host}")
    for e, element in enumerate(page.elements):  # parents come first
        sequence: list[str] = []
        places = []
        for child in element.parts:
            if child >= 0:
                label = _label(page, child)
                if not sequence or sequence[-1] != label:
                    sequence.append(label)
                places.append((child, len(sequence) - 1, label))
        if sequence:
            styles[e] = _hash("\n".join(sequence))
            for child, place, label in places:
                ids[child] = _hash(f"{ids[e]} {styles[e]} {place} {label}")
    return ids, styles


def text_key(node: int, block: str) -> int:
    """A text of a node; texts that differ in numbers or case only are the same content."""
    return _hash(f"{node}/{_DIGITS.sub('0', block).casefold()}")


def nodes(pages: DataFrame) -> DataFrame:
    """``pages``: key, host, html. The styles and texts of each page by node."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "html", STEP):
                out = []
                for row in rows.to_pylist():
                    page = parsed(row["html"])
                    ids, styles = node_ids(page, row["host"])
                    counts = Counter(zip(ids, styles))
                    seen: set[int] = set()
                    presentation = []
                    for (node, style), n in counts.items():
                        presentation.append({"id": node, "style": style, "n": n, "pages": int(node not in seen)})
                        seen.add(node)
                    texts = {(ids[e], text_key(ids[e], page.blocks[~part])) for e, x in enumerate(page.elements) for part in x.parts if part < 0}
                    out.append({"key": row["key"], "styles": presentation, "texts": [{"id": i, "text": t} for i, t in sorted(texts)]})
                yield pa.RecordBatch.from_pylist(out, schema=_NODES)

    return pages.mapInArrow(read, NODES)


def importance(distinct: DataFrame) -> DataFrame:
    """``distinct``: :func:`nodes` of distinct pages. Rows (id, value, styles, pages): importance of the presentation of each
    node in two or more pages, and of each of its texts (``id`` is that of the text, ``styles`` 0) that stands in two or more.
    """
    style = distinct.select(F.explode("styles").alias("s")).groupBy("s.id", "s.style").agg(F.sum("s.n").alias("n"), F.sum("s.pages").alias("pages"))
    node = style.groupBy("id").agg(
        F.sum("n").alias("all"), F.sum("pages").alias("pages"), F.count(F.lit(1)).alias("styles"), F.sum(F.col("n") * F.log("n")).alias("n_log_n")
    ).where("pages > 1")
    entropy = F.greatest(F.lit(0.0), 1 - F.col("n_log_n") / (F.col("all") * F.log("all")))
    presentation = node.select("id", entropy.alias("value"), F.col("styles").cast("int").alias("styles"), F.col("pages").cast("int").alias("pages"))
    shared = distinct.select(F.explode("texts").alias("t")).groupBy("t.id", "t.text").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    content = shared.join(node.select("id", "pages"), "id").select(F.col("text").alias("id"), (1 - F.log("n") / F.log("pages")).alias("value"), F.lit(0).alias("styles"), F.col("pages").cast("int").alias("pages"))
    return presentation.unionByName(content)


class Looks:
    """What a page shows by itself, by element: text, links, names."""

    def __init__(self, page: Page) -> None:
        self.page = page
        n = len(page.elements)
        self.size, self.linked, self.prior = [0] * n, [0] * n, [0.0] * n
        self.heads, self.articles = [0] * n, [0] * n
        self.other = [False] * n
        self.inside = [False] * n
        self.article_size = [0] * n  # of the marked article that an element lies in
        for e in range(n - 1, -1, -1):  # children come after their parents
            element = page.elements[e]
            for part in element.parts:
                if part < 0:
                    size = len(page.blocks[~part])
                    self.size[e] += size
                    self.linked[e] += page.linked[~part]
                    self.prior[e] += size * self.of_block(~part, element.tag)
                else:
                    self.size[e] += self.size[part]
                    self.linked[e] += self.linked[part]
                    self.prior[e] += self.size[part] * self.prior[part]
                    self.heads[e] |= self.heads[part] or page.elements[part].tag in ("h1", "h2")
                    self.articles[e] = max(self.articles[e], self.articles[part], self.size[part] if self.is_article(part) else 0)
            self.prior[e] /= max(1, self.size[e])
        for e in range(1, n):
            up = page.elements[e].parent
            self.inside[e] = self.inside[up] or self.is_article(e)
            self.article_size[e] = self.article_size[up] or (self.size[e] if self.is_article(e) else 0)
            self.other[e] = self.other[up] or self.is_other(e)
        size = [0, 0]  # of the page without other things, and of that in marked articles
        for e, element in enumerate(page.elements):
            if not self.other[e]:
                own = sum(len(page.blocks[~p]) for p in element.parts if p < 0)
                size[0] += own
                size[1] += own * self.inside[e]
        self.marked = size[1] > 0 and size[1] >= ARTICLE_SHARE * size[0]

    def of_block(self, block: int, tag: str) -> float:
        text = self.page.blocks[block]
        if self.page.linked[block] > 0.5 * len(text):
            return 0.1
        if tag in ("h1", "h2", "h3", "h4"):
            return 0.8
        return 0.9 if len(text) >= 60 or _SENTENCE.search(text) else 0.5

    def is_article(self, e: int) -> bool:
        element = self.page.elements[e]
        return element.tag in MAIN_TAGS or element.names.get("role", "").lower() in ("main", "article") or "articlebody" in element.names.get("itemprop", "").lower()

    def is_other(self, e: int) -> bool:
        """Whether the element says that it is something else than the article."""
        element = self.page.elements[e]
        names = element.names
        if element.tag in ("nav", "aside", "footer"):
            return True
        if "hidden" in names or names.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(names.get("style", "")):
            return True
        words = {w.lower() for w in _NAME.findall(f"{names.get('class', '')} {names.get('id', '')}")}
        roles = set(names.get("role", "").lower().split())
        if element.tag == "header" or words & HEADER_NAMES:
            return not (self.heads[e] and self.inside[element.parent]) and not self.holds_article(e) and not (self.heads[e] and self.size[e] > 0.5 * self.size[0])
        if element.tag in OTHER_TAGS or words & OTHER_NAMES or roles & OTHER_ROLES:
            return not self.holds_article(e)
        return False

    def holds_article(self, e: int) -> bool:
        """A wrapper of most of the page, whatever its name."""
        whole = self.size[0]
        return self.articles[e] > 0.5 * whole or self.heads[e] and self.size[e] > 0.6 * whole


def kept_blocks(page: Page, ids: list[int], known: dict[int, tuple[float, int, int]]) -> list[str]:
    """Blocks of the branches that are important enough, in page order."""
    looks = Looks(page)
    n = len(page.elements)
    value, pages = [1.0] * n, [1] * n
    for e in range(n - 1, -1, -1):
        presentation, styles, pages[e] = known.get(ids[e], (1.0, 1, 1))
        below = [known.get(text_key(ids[e], page.blocks[~p]), (1.0, 0, 0))[0] if p < 0 else value[p] for p in page.elements[e].parts if p < 0 or looks.size[p]]
        if not below:
            continue
        mean = sum(below) / len(below)
        holds = any(p >= 0 for p in page.elements[e].parts)
        value[e] = (1 - DECAY**styles) * presentation + DECAY**styles * mean if holds else mean
    out: list[int] = []
    pending = [0]
    while pending:
        e = pending.pop()
        if e < 0:
            out.append(~e)
            continue
        if e:
            trust = (pages[e] - 1) / (pages[e] - 1 + TRUST)
            score = trust * value[e] + (1 - trust) * looks.prior[e]
            if looks.is_article(e) or looks.inside[e] and (looks.heads[e] or looks.size[e] > 0.3 * looks.article_size[e]):
                score = 1.0  # the article, its headline, a good part of it
            elif looks.inside[e] and page.elements[e].tag in PROSE_TAGS:
                # repeated prose in a marked article is still the article; for lists of links the host decides
                links = page.elements[e].tag in LIST_TAGS and looks.linked[e] > 0.5 * looks.size[e]
                score = trust * value[e] + (1 - trust) * 0.5 if links else 1.0
            outside = looks.marked and not looks.inside[e] and not looks.articles[e]
            if looks.other[e] or outside or score < LEAST_IMPORTANCE:
                continue
        elif looks.marked and any(p < 0 for p in page.elements[0].parts):
            pending.extend(p for p in reversed(page.elements[0].parts) if p >= 0)
            continue
        pending.extend(reversed(page.elements[e].parts))
    return [page.blocks[k] for k in out]


def main_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per page: its id and url, the ``text`` of its article (blocks joined by empty lines), the code points of it
    (``n_chars``) and of all text of the page (``n_page_chars``)."""
    ship(pages.sparkSession)
    host = F.regexp_extract(F.lower(F.coalesce(F.col(url_column), F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    keyed = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), host.alias("host"), whole_text(html_column).alias("html"))
    keyed = keyed.withColumn("key", F.xxhash64("host", "html"))

    found = written(nodes(keyed.select("key", "host", "html")).withColumn("serial", F.monotonically_increasing_id()), "site-nodes")
    copies = found.groupBy("key").agg(F.min("serial").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    distinct = found.join(copies, "key", "left").where("least IS NULL OR least = serial").drop("least", "serial")
    known = written(importance(distinct), "site-importance")

    # of each page the nodes and texts that it has in common with another one
    entries = F.concat(F.array_distinct(F.transform("styles", lambda s: s["id"])), F.transform("texts", lambda t: t["text"]))
    entries = distinct.select("key", F.explode(entries).alias("id"))
    told = entries.join(known, "id").groupBy("key").agg(F.collect_list(F.struct("id", "value", "styles", "pages")).alias("known"))

    fields = [pages.schema[id_column].dataType, pages.schema[url_column].dataType, StringType(), LongType(), LongType()]
    schema = StructType([StructField(n, t) for n, t in zip(("page_id", "url", "text", "n_chars", "n_page_chars"), fields)])

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = pa.array([zstandard.compress(h.encode("utf-8", "surrogatepass"), 1) for h in batch.column("html").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), packed], names=names)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "html", STEP):
                texts, sizes, wholes = [], [], []
                for source, at, entries in zip(rows.column("html").to_pylist(), rows.column("host").to_pylist(), rows.column("known").to_pylist()):
                    page = parsed(zstandard.decompress(source).decode("utf-8", "surrogatepass"))
                    ids, _ = node_ids(page, at)
                    blocks = kept_blocks(page, ids, {x["id"]: (x["value"], x["styles"], x["pages"]) for x in entries or ()})
                    texts.append("\n\n".join(blocks))
                    sizes.append(len(texts[-1]))
                    wholes.append(sum(map(len, page.blocks)))
                columns = [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(wholes, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    # pages meet what is known of their nodes in a shuffle; they travel compressed
    names = ["key", "page_id", "url", "host", "html"]
    small = keyed.select(*names).mapInArrow(shrink, StructType([*(keyed.schema[c] for c in names[:-1]), StructField("html", BinaryType())]))
    return small.join(told, "key", "left").select("page_id", "url", "host", "html", "known").mapInArrow(extract, schema)
