"""Page text, chat formatting and both vector searches against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitegrade.llm import ball_tree, chat_format, hilbert_search, html_text

# ---- pages ---------------------------------------------------------------------
FULL_PAGE = """<!DOCTYPE html><html><head><title>Skip &amp; me</title><style>p > a {x:1}</style>
<script>var t = "<p>not text</p>";</script></head><body class="has-sidebar">
<!-- <p>commented</p> --><header><h2>Site name</h2><form action="/s"><input name="q">Search here</form></header>
<nav><ul><li><a href="/">Home</a><li><a href="/b">News</a></ul></nav>
<div id="cookie-notice">We use cookies, lots of them.</div>
<div class="ad banner">Buy now, cheap and quick.</div>
<main><article><header><h1>The  title &lt;one&gt;</h1></header>
<p>First &amp; best,<br>second line of <a href="x>y">a link</a>.
<p>Unclosed paragraph &eacute;&#233;&nbsp;end.
<ul><li>Item one<li>Item two</ul>
<div class="ad">Inline advert.</div>
<pre>code   here</pre><script>track("</p>")</script>
<section class="comments"><h3>Comments</h3><article class="comment"><p>I agree, very long comment of a reader.</p></article></section>
</article></main><aside class="sidebar"><p>Related stories, many of them to read.</p></aside>
<footer>&copy; nobody</footer></body></html>"""
FULL_TEXT = "\n".join([
    "The title <one>", "First & best, second line of a link.", "Unclosed paragraph éé end.",
    "Item one", "Item two", "code here"])
PLAIN_PAGE = (
    "<div class=menu><a href=/a>A</a> <a href=/b>B</a></div><div id=content>"
    + "".join(f"<p>Paragraph {i}, with a number of words, and some commas.</p>" for i in range(4))
    + "</div><div class='footer-links'><a href=/x>Imprint</a></div>")


def test_main_text_of_pages(spark):
    pages = [(1, "u1", FULL_PAGE, "t"), (2, "u2", None, "t"), (3, None, "", "t"), (None, "u4", "<p", "t"),
             (5, "u5", PLAIN_PAGE, "t"), (6, "u6", "<nav>only menu</nav>", "t"), (5, "u5", PLAIN_PAGE, "t"),
             (7, "u7", "<article>" + "<p>word &am text</p>" * 5000 + "</article>", "t"),
             (8, "u8", "<article><p>kept</p><script>lost</article>", "t")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    got = html_text.extract_pages(df).collect()
    assert len(got) == len(pages)
    text = {r.url or r.page_id: r.text for r in got}
    assert text["u1"] == FULL_TEXT
    assert text["u2"] == "" and text[3] == "" and text["u6"] == ""
    assert text["u5"].split("\n") == [
        f"Paragraph {i}, with a number of words, and some commas." for i in range(4)]
    assert text["u7"] == "\n".join(["word &am text"] * 5000) and text["u8"] == "kept"
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract_pages(df.limit(0)).count() == 0


@pytest.mark.parametrize("page, want", [
    ("<html><head><title>x</title><body><article><p>Body tag ends it.</article>", "Body tag ends it."),
    ("<head><meta charset=a><style>p{}</style><article><p>Block ends it.</article>", "Block ends it."),
    ("<head><title>x</title><b>Any element</b> ends it.", "Any element ends it."),
    ("<head><title>x</title> Text ends it.", "Text ends it."),
    ("<head><noscript><link href=a><body><p>Noscript left open.", "Noscript left open."),
    ("<head><noscript><p>hidden</noscript><title>x</title></head><p>Closed as before.", "Closed as before."),
    ("<article><p>Before <svg class='i' /> after.<p>Next.</article>", "Before after.\nNext."),
    ("<article><p>A <svg><title/><style/><path d='a'/><text>no</text></svg> b.</article>", "A b."),
    ("<article><p>Icon <svg><path d=a><p>left open.</article>", "Icon\nleft open."),
    ("<article><p>See <svg><foreignObject><p>no</p></foreignObject></svg>it.</article>", "See\nit."),
    ("<article><p>So <math><mi>a</mi><mo>=</mo><mspace width=a /><mn>2</mn><annotation>tex</annotation>"
     "</math> holds.</article>", "So a=2 holds."),
    ("<article><p>None <math/> here.</article>", "None here."),
])
def test_blocks_after_open_heads_drawings_and_formulas(page, want):
    assert "\n".join(b.text for b in html_text.page_blocks(page)) == want


PARAGRAPHS = [f"Paragraph {i} of the text, with a number of words, some commas, and more of them to read on."
              for i in range(4)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
STORIES = "<ul>" + "".join(f"<li><a href=/{i}>Other story {i}</a></li>" for i in range(5)) + "</ul>"
READERS = "".join("<p>I agree with all of it, and so do many others I know.</p>" for _ in range(3))


@pytest.mark.parametrize("page", [
    f"<div id='content' class='with-sidebar'>{BODY}</div>",
    f"<div class='post-header'>{BODY}</div>",
    f"<div class='entry-content share-open'>{BODY}</div>",
    f"<article class='post no-comments'>{BODY}</article>",
    f"<article class='post type-post category-share comments-open'><div class=entry>{BODY}</div></article>",
    f"<form id=all>{BODY}</form>",
    f"<article>{BODY}{STORIES}</article>",  # link list without a name
    f"<article>{BODY}<div><a href=/a>New shoes</a><div><a href=/b>Half price</a></div><div><a href=/b>Buy now</a></div></div></article>",  # advert without a name
    f"<article>{BODY}</article><div class='post-comments'>{READERS}</div>",
    f"<article>{BODY}<article class=comment>{READERS}</article></article>",
    f"<article>{BODY}</article><div class=sidebar><p>Short words.</p>{STORIES}</div>",
    f"<div class='post-share'>{STORIES}</div><div class=post>{BODY}</div>",
])
def test_mixed_names_and_unnamed_boilerplate(page):
    assert html_text.main_text(page, html_text.PRIOR).split("\n") == PARAGRAPHS


def test_lists_of_an_article_stay():
    page = f"<article>{BODY}<ul><li>Item one<li>Item two</ul>{BODY}</article>"
    assert html_text.main_text(page, html_text.PRIOR).split("\n") == [*PARAGRAPHS, "Item one", "Item two", *PARAGRAPHS]


def test_minimum_cut_equals_trying_all_labels():
    rng = random.Random(8)
    for _ in range(150):
        n = rng.randrange(1, 9)
        gain = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a) if rng.random() < 0.6]

        def cost(label):
            return -sum(g for g, x in zip(gain, label) if x) + sum(
                w for a, b, w in edges if label[a] != label[b])

        best = min(cost(x) for x in itertools.product((False, True), repeat=n))
        assert cost(html_text.minimum_cut(gain, edges)) == pytest.approx(best)


# ---- chats ---------------------------------------------------------------------
def test_formatted_chats_read_back(spark):
    odd = "<|turn|>a<|body|>b<|end|> & &lt; &amp;lt; </s>[INST] ü🙂"
    rows = [(1, 0, "user", odd), (1, 1, "assistant", odd), (1, 2, "assistant", ""), (1, 3, "user", None),
            (2, None, None, "x"), (2, 5, "assistant", "same"), (2, 5, "assistant", "same"),
            (None, 0, "user", "no id"), (3, 0, "system<|turn|>", "s"), (4, 1, "assistant", "long " * 40_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = df.select("*", chat_format.text_part(F.col("text")).alias("parts"),
                      F.lit("x").alias("body"), F.lit(1).alias("attachments"))
    got = {r.conv_id: r for r in chat_format.conversation_digests(parts).collect()}
    assert len(got) == 5
    for conv, r in got.items():
        turns = sorted((x for x in rows if x[0] == conv),
                       key=lambda x: (x[1] is not None, x[1], x[2] or "", x[3] or ""))
        told = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in turns)
        loss = "".join(x[3] or "" for x in turns if x[2] == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_format.conversation_digests(parts.limit(0)).count() == 0


def test_parts_become_ordered_placeholders(spark):
    rows = [(1, 0, "user", [("text", "see <", None, None), ("image", None, "i1", 784.0 * 3), ("text", "and", None, None),
                            ("audio", "x", "a1", 2.0), ("document", None, None, None), (None, "!", None, None), None]),
            (1, 1, "assistant", None)]
    df = spark.createDataFrame(rows, f"conv_id int, turn int, role string, parts {chat_format.PARTS}")
    r = chat_format.format_conversations(df).first()
    assert r.formatted == ("<|turn|>user<|body|>see &lt;<|image|>and<|audio|><|document|>!<|end|>"
                           "<|turn|>assistant<|body|><|end|>")
    assert [(a.kind, a.ref, a.tokens) for a in r.attachments] == [
        ("image", "i1", 3), ("audio", "a1", 50), ("document", None, 1)]


# ---- vectors -------------------------------------------------------------------
def _vectors(n, width=12, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) / np.sqrt(width)
    x[n // 2:n // 2 + 30] = x[0]  # ties
    return x


BAD = [(90_000, None), (90_020, [None, 1.0]), (90_040, [float("nan"), 1.0]), (90_060, [float("inf")]), (None, [1.0])]


def _table(spark, x):
    rows = [(int(i), [float(v) for v in row], "s") for i, row in enumerate(x)]
    return spark.createDataFrame(
        [*rows, *[(i, v, "s") for i, v in BAD], rows[0]], "vec_id long, embedding array<float>, score string")


def test_exact_top_k_equals_brute_force(spark):
    x = _vectors(500)
    grid = ball_tree.grid_vectors(_table(spark, x))
    asked = grid.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    v = np.floor(64 * x.astype(np.float32).astype(np.float64)).astype(int)
    want = set()
    for q in range(0, 500, 20):
        score = v @ v[q]
        order = sorted((int(-score[i]), i) for i in range(500) if i != q)[:20]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(order)}
    for shard, block in ((4096, 1024), (90, 7)):
        got = ball_tree.exact_top_k(grid, asked, 20, shard, block)
        assert {tuple(r) for r in got.collect()} == want
    few = ball_tree.exact_top_k(grid.where("vec_id < 3"), asked.where("query_id = 0"))
    assert [r.rank for r in few.orderBy("rank").collect()] == [1, 2]
    assert ball_tree.exact_top_k(grid.limit(0), asked.limit(0)).count() == 0


def test_exact_search_handles_large_numbers_and_bounds():
    rng = np.random.default_rng(3)
    points = rng.integers(-2**29, 2**29, (300, 4))
    ids = np.arange(300)
    found = ball_tree.search(ids[:9], points[:9], ids, points, 5, np.full(9, -np.inf))
    for q in range(9):
        score = points @ points[q]
        want = sorted((-int(score[i]), i) for i in range(300) if i != q)[:5]
        rows = [(-int(s), int(i)) for o, i, s in zip(*found) if o == q]
        assert rows == want


def test_hilbert_keys_visit_neighbouring_cells():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    order = np.argsort(hilbert_search.hilbert_keys(cells, 3))
    steps = np.abs(np.diff(cells[order], axis=0)).sum(axis=1)
    assert sorted(hilbert_search.hilbert_keys(cells, 3)) == list(range(512)) and (steps == 1).all()


def test_nearest_neighbours_recall_and_scores(spark):
    x = _vectors(2000, 16, 5).astype(np.float32).astype(np.float64)
    table = _table(spark, x)
    vectors = hilbert_search.usable_vectors(table.unionByName(
        spark.createDataFrame([(91_000, [0.0, 0.0], "z")], table.schema)))
    assert vectors.count() == 2001  # the repeated row is still there
    asked = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"))
    curves = hilbert_search.Curves(curves=12, least_block=64, slice_rows=100)
    got = {}
    for r in hilbert_search.nearest(vectors, asked, 20, curves).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert len(got) == 100
    hits = 0
    for q, rows in got.items():
        score = x @ x[q]
        best = sorted((-score[i], i) for i in range(2000) if i != q)[:20]
        assert [r[0] for r in sorted(rows)] == list(range(1, 21))
        for _, i, s in rows:
            assert s == pytest.approx(score[i], abs=1e-12) and i != q
        assert sorted(rows) == sorted(rows, key=lambda r: (-r[2], r[1]))
        hits += len({i for _, i in best} & {r[1] for r in rows})
    assert hits / 2000 >= 0.9
    assert hilbert_search.nearest(vectors.limit(0), asked.limit(0)).count() == 0


@pytest.mark.parametrize("page", [
    "<div>word text here " * 200_000,
    "<b>" * 100_000 + "<p>word text</p></i></span></b>" * 100_000,
    "<table><tr><td>" * 50_000 + "cell </td></u></tr></table>" * 50_000,
    "<svg><desc>" * 50_000 + "<g/></x>" * 50_000,
])
def test_deep_pages_take_time_in_proportion(page):
    start = time.time()
    text = html_text.main_text(page, html_text.PRIOR)
    assert isinstance(text, str) and time.time() - start < 60
