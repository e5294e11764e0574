"""Main text of pages: blocks by hand, site statistics against plain counting, articles of made-up sites."""

import math
import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from linetally.llm import main_text
from linetally.llm.dom import parsed

SF = "/root/testdata/sf0.001"
COLUMNS = "page_id long, url string, html string, host string, key long, known string, text string"


def blocks(html):
    return parsed(html).blocks


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("", []),
        ("plain  text\n here", ["plain text here"]),
        ("<p>one<p>two <b>bold</b>\n<br>line<div>three</div>four", ["one", "two bold line", "three", "four"]),
        ("<p>a &amp;amp; b &lt;i&gt; &#233;&#xE9; &copy &nbsp; c", ["a &amp; b <i> éé © c"]),
        ("<script>if (a<b) '</p>'</script><style>p{}</style><title>t</title><!-- <p>no</p> -->x", ["x"]),
        ("<SCRIPT>never closed <p>x", []),
        ("a < b and 1<2 <3", ["a < b and 1<2 <3"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]),
        ('<div title="a > b" data-x=\'<p>\' class=k>in</div></div></span>out', ["in", "out"]),
        ("<p>half <a href='x'>link</a></p><p", ["half link"]),
        ("<p><b>Title<br><p>Body</b> goes on</p>", ["Title", "Body goes on"]),
        ("<!DOCTYPE html><?xml?><![CDATA[x]]>y", ["y"]),
        ("<div>" * 5000 + "deep", ["deep"]),
    ],
)
def test_blocks(html, want):
    assert blocks(html) == want


def run(spark, rows):
    pages = spark.createDataFrame([(*r, "h", 1, "k", "t") for r in rows], COLUMNS)
    return {r["page_id"]: r["text"] for r in main_text.main_text(pages).collect()}


def sentence(rng, n=14):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n)).capitalize() + "."


def page(rng, host, k, around):
    """A page without any names, and its article: only the other pages of the host tell what is what."""
    title, *body = [sentence(rng) for _ in range(rng.randrange(3, 7))]
    article = [title, *body]
    html = f"<html><body><div><div>{around[0]}</div><ul><li>{around[1]}<li>{around[2]}</ul></div><div><h2>{title}</h2>"
    return html + "".join(f"<p>{b}</p>" for b in body) + f"</div><div><p>{around[3]}</p><p>{around[rng.randrange(4, 7)]}</p></div></body></html>", article


def test_site_without_names(spark):
    """What stands on every page of a host goes, the article stays; a page of another host keeps the same words."""
    rng = random.Random(2)
    around = [sentence(rng, 30) for _ in range(7)]
    rows, want = [], {}
    for k in range(150):
        html, article = page(rng, "a", k, around)
        rows.append((k, f"https://a.example.org/{k}", html))
        want[k] = "\n\n".join(article)
    rows.append((900, "http://b.example.org/", f"<div><p>{around[0]}</p><p>{sentence(rng)}</p></div>"))
    got = run(spark, rows)
    assert all(got[k] == want[k] for k in want)
    assert got[900].startswith(around[0])


def test_named_branches(spark):
    """Headers, menus, sidebars, notices, adverts, forms, reader comments go, on a host of one page and where they differ."""
    rng = random.Random(3)
    rows, want = [], {}
    for k in range(12):
        s = [sentence(rng) for _ in range(12)]
        html = (
            f'<body class="has-sidebar"><header><h1>{s[0]}</h1></header><div class="cookie-notice">{s[1]}</div><div id="page"><div class="post-body">'
            f'<h2>{s[2]}</h2><p>{s[3]}</p><div class="adSlot">{s[4]}</div><blockquote>{s[5]}</blockquote><table><tr><td>{s[6]}<td>{s[7]}</table></div>'
            f'<div id="comments"><p>{s[8]}</p></div><form>{s[9]}<button>b</button></form></div><div class="sidebar_right">{s[10]}</div>'
            f'<div role="contentinfo">{s[11]}</div>'
        )
        rows.append((k, f"http://h{k if k < 3 else 'x'}.example.com", html))
        want[k] = "\n\n".join([s[2], s[3], s[5], s[6], s[7]])
    assert run(spark, rows) == want


def test_marked_article(spark):
    """Copies of an article all over a host stay, with its headline, links and header; what is outside goes."""
    text = "<header><h1>Head</h1></header><p>Copied text of some length, the same on all pages.</p><p><a href=x>Only a link</a></p><aside>no</aside><ul><li>point</ul>"
    rows = [(k, "//user@c.example.net:80/x", f"<div>Today {k}, unlike others: {k * 7919}.</div><article>{text}</article><article class=comment>Reply {k}.</article>") for k in range(60)]
    assert set(run(spark, rows).values()) == {"Head\n\nCopied text of some length, the same on all pages.\n\nOnly a link\n\npoint"}


def test_edges(spark):
    long = "<p>" + "word " * 100_000 + "end.</p>"
    rows = [(1, None, None), (2, "u", ""), (3, "not a url", "<nav>x</nav>"), (4, None, "Just text."), (5, "http://x.y", long), (6, "http://x.y", "<p>é漢\U0001f600\u0000 text."), (None, None, "<p>Null id, of a page.")]
    got = run(spark, [*rows, rows[3]])
    assert got == {1: "", 2: "", 3: "", 4: "Just text.", 5: "word " * 100_000 + "end.", 6: "é漢\U0001f600\u0000 text.", None: "Null id, of a page."}
    pages = spark.createDataFrame([(*r, "h", 1, "k", "t") for r in [*rows, rows[3]]], COLUMNS)
    assert main_text.main_text(pages).count() == 8
    assert not main_text.main_text(pages.limit(0)).collect()


def test_importance_same_as_counting(spark):
    rng = random.Random(5)
    around = [sentence(rng, 5) for _ in range(7)]
    htmls = [page(rng, "a", k, around)[0] for k in range(25)]
    rows = [(k, "h", html) for k, html in enumerate(htmls)]
    found = main_text.importance(main_text.nodes(spark.createDataFrame(rows, "key long, host string, html string")))
    styles, inside, texts = defaultdict(Counter), defaultdict(set), defaultdict(set)
    for k, html in enumerate(htmls):
        p = parsed(html)
        ids, own = main_text.node_ids(p, "h")
        for e, x in enumerate(p.elements):
            styles[ids[e]][own[e]] += 1
            inside[ids[e]].add(k)
            for part in x.parts:
                if part < 0:
                    texts[ids[e], main_text.text_key(ids[e], p.blocks[~part])].add(k)
    want = {}
    for i, c in styles.items():
        if len(inside[i]) > 1:
            n = sum(c.values())
            want[i] = -sum(v / n * math.log(v / n, n) for v in c.values())
    for (i, t), at in texts.items():
        if len(at) > 1:
            want[t] = 1 - math.log(len(at), len(inside[i]))
    got = {r["id"]: r["value"] for r in found.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_articles_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in main_text.main_text(pages).collect()}
    for row in pages.collect():
        inner = row["html"].split("<article>")[1].split("</article>")[0]
        assert got[row["page_id"]]["text"] == "\n\n".join(blocks(inner))
        assert got[row["page_id"]]["n_chars"] == len(got[row["page_id"]]["text"])
