from __future__ import annotations

import html
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paytrail.llm import html_extraction, layouts, recurrent, registry
from paytrail.llm.blocks import PATH_BUCKETS, read_blocks

from .texts import prose

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def weights(spark):
    return html_extraction.fit(spark.read.parquet(f"{SAMPLE}/pages.parquet"), html_extraction.Settings())


def article(page):
    """The article of the sample's own template, without a parser."""
    body = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>", "", body[1].replace("<br>", " "))) if body else []
    return "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)


def test_query_on_the_smallest_sample(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SAMPLE}/pages.parquet").collect()}
    got = registry.queries()["op12_html_extraction"](spark, SAMPLE).collect()
    assert len(got) == len(pages)
    for r in got:
        want = article(pages[r["page_id"]]["html"])
        assert (r["url"], r["text"], r["n_chars"]) == (pages[r["page_id"]]["url"], want, len(want))


def page_of_another_make(seed):
    """A page without article elements, and its main text."""
    r = random.Random(seed)
    text = [prose(r.randint(8, 60), seed * 31 + i) for i in range(r.randint(3, 9))]
    esc = lambda t: html.escape(t).replace(" ", "\n ", 2)
    boxes = [('<div class="article-body">', "</div>"), ('<div id="content"><div class="post">', "</div></div>"), ("<main>", "</main>")]
    a, b = r.choice(boxes)
    page = f"""<!doctype html><HTML><head><title>{esc(text[0])}</title><style>p > b {{}}</style></head><body data-x="a>b">
    <header class="site-header"><a href=/>Home</a> {prose(3, seed)}</header><ul class="nav-menu"><li><a href=1>{prose(1, 1)}<li><a href=2>{prose(2, 2)}</ul>
    <div class="cookie-notice">{prose(14, seed + 1)}<button>OK {prose(2, 3)}</button></div>{a}<h1>{esc(text[0])}</h1>
    {"".join(f"<p>{esc(t)}" for t in text[1:-1])}<ul><li>{esc(text[-1])}</ul>{b}
    <section id="comments"><div class="comment"><p>{prose(20, seed + 2)}</p></div><div class="comment"><p>{prose(11, seed + 3)}</p></div></section>
    <aside class="sidebar"><h3>{prose(3, 4)}</h3><p>{prose(18, seed + 5)}</p></aside><div class="advert">{prose(9, seed + 6)}</div>
    <form action=x><label>{prose(4, 7)}</label><textarea><p>{prose(9, 8)}</textarea></form>
    <script>if (1 < 2) document.write("<p>no</p>")</script><footer>&copy; {prose(12, seed + 9)}</footer></body>"""
    return page, "\n\n".join(" ".join(t.split()) for t in text)


def test_pages_of_other_makes(weights):
    pages = [page_of_another_make(i) for i in range(60)]
    got = html_extraction.main_texts(weights, [p for p, _ in pages])
    right = sum(g == w for g, (_, w) in zip(got, pages, strict=True))
    blocks = lambda t: set(t.split("\n\n"))
    found = sum(len(blocks(g) & blocks(w)) for g, (_, w) in zip(got, pages, strict=True))
    said, wanted = sum(len(blocks(g)) for g in got), sum(len(blocks(w)) for _, w in pages)
    assert right >= 54 and found / wanted > 0.97 and found / said > 0.97, (right, found / wanted, found / said)


def test_labels_depend_on_the_rest_of_the_page(weights):
    """Without names, a paragraph among link lists and one among paragraphs aren't told apart by themselves."""
    lone = read_blocks(f"<div><a href=1>one</a></div><div>{prose(6, 1)}</div><div><a href=2>two</a></div><div><a href=2>three</a></div>")
    among = read_blocks("".join(f"<div>{prose(40, i)}</div>" for i in range(3)) + f"<div>{prose(6, 1)}</div>" + f"<div>{prose(50, 9)}</div>")
    score = lambda page, i: float(recurrent.margins(weights, html_extraction.featurise([page]))[i])
    assert lone[1].text == among[3].text and score(among, 3) > score(lone, 1)


@pytest.mark.parametrize(
    "page, texts",
    [
        ("", []),
        ("a < b & c &lt;p&gt; &#233;&eacute &nosuch;", ["a < b & c <p> éé &nosuch;"]),
        ("<p>one<b>two</b> <i>three<p>four", ["onetwo three", "four"]),
        ("<p>a&nbsp;\n\t b<br>c</p><!-- <p>no --><!--><p>d", ["a b c", "d"]),
        ("<script>var t='</p>'</script><p title='x>y' x=\"</p>\">e</p><style>f", ["e"]),
        ("<ul><li>a<li><p>b<ul><li>c</ul><li>d</ul>e", ["a", "b", "c", "d", "e"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>", ["a", "b", "c"]),
        ("<select><option>x</select>y<svg><text>z</text></svg><svg/>w<textarea>v", ["y", "w"]),
        ("</p></div>a</nosuch>b<", ["a", "b<"]),
        ("<div" * 3 + " a='", []),
        ("<b>" * 2_000 + "<div>x" * 2_000, ["x"] * 2_000),
    ],
)
def test_blocks(page, texts):
    assert [b.text for b in read_blocks(page)] == texts


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/!-=\"'& abpscript", max_size=80))
def test_any_text_is_read(page):
    for b in read_blocks(page):
        assert b.text and b.text == " ".join(b.text.split())


def test_links_and_paths():
    blocks = read_blocks('<div class="navMenus item2"><a href=x>abc</a> d</div><p hidden>e</p><article><header><h1>f</h1></header></article>')
    assert blocks[0].linked == 3 and {"<div>", "nav", "menu", "item"} == blocks[0].words
    assert "hidden" in blocks[1].words
    assert layouts.weak_labels(blocks) == [0, 0, 1]


def test_gradients_equal_differences():
    pages = [read_blocks(page_of_another_make(i)[0]) for i in range(3)]
    items = html_extraction.featurise(pages)
    labels = np.array([y for p in pages for y in layouts.weak_labels(p)], float)
    w = {k: v.astype(np.float64) for k, v in recurrent.new_weights(PATH_BUCKETS, html_extraction.WORD_BUCKETS).items()}
    _, grad = recurrent.gradients(w, items, labels)
    for name, g in grad.items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        losses = []
        for step in (1e-3, -2e-3):
            w[name][at] += step
            losses.append(recurrent.gradients(w, items, labels)[0])
        w[name][at] += 1e-3
        assert abs((losses[0] - losses[1]) / 2e-3 - g[at]) < 1e-3 * max(abs(g[at]), 1e-2)


def test_batches_do_not_change_results(weights):
    pages = [read_blocks(page_of_another_make(i)[0]) for i in range(20)] + [[]]
    together = recurrent.margins(weights, html_extraction.featurise(pages), cells=64)
    alone = np.concatenate([recurrent.margins(weights, html_extraction.featurise([p])) for p in pages if p])
    assert np.allclose(together, alone, atol=1e-4)


def test_nulls_ties_long_pages_and_clashing_columns(spark, weights):
    long = "<article>" + "".join(f"<p>{prose(30, i)}</p>" for i in range(3_000)) + f"<p>{'x' * 300_000}</p></article><footer>end</footer>"
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<article><p>one two</p></article>"), (4, "w", "<nav>only a menu</nav>"), (5, "l", long), (5, "l", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'own' AS text", "'x' AS n_chars", "'y' AS hash")
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in html_extraction.extract(pages, weights).collect()), key=str)
    want = article(long)
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (None, "v", "one two", 7), (4, "w", "", 0), (5, "l", want, len(want)), (5, "l", want, len(want))], key=str)
    empty = pages.limit(0)
    assert html_extraction.extract(empty, html_extraction.fit(empty)).count() == 0
