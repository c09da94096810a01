"""Main text of pages: regions by markup, and repeated runs against a plain search."""

import re
from collections import defaultdict

import numpy as np
import pytest

from roompulse.llm import page_text


def text(page, *roles):
    return " ".join(t for r, t in page_text.page_blocks(page) if r in (roles or (page_text.MAIN, page_text.OPEN)))


@pytest.mark.parametrize("page, expected", [
    ("", ""),
    ("plain words\n  only", "plain words only"),
    ("<nav><a href='/x'>Home</a></nav><article><h1>T</h1><p>a<b>b</b>c<br>d&amp;e &lt;x&gt;&#33;</p></article><footer>f</footer>", "T abc d&e <x>!"),
    ("<article><p><b>One<br><p>two</p><p><b>three", "One two three"),
    ("<article><p>a</p><aside>s</aside><div class='share-box'>Share</div><p class=ad>buy<p>b</article>", "a b"),
    ("<article><header><h1>Title</h1><p>by me</p></header><p>body</p><footer>tags</footer></article>", "Title body"),
    ("<header><h1>Site</h1></header><main><p>m</p><article><p>a</p></article></main>", "a"),
    ("<div>x</div><main><p>m</p></main>", "m"),
    ("<article>one</article><p>between</p><article>two</article>", "one two"),
    ("<article><p>a</p><section id='comments'><article><p>I disagree</p></article></section></article>", "a"),
    ("<article>a<form><label>Mail</label><input></form><script>if (a<b) {'</p>'}</script><style>p{}</style>b</article>", "a b"),
    ("<!DOCTYPE html><html class='nav-open'><head><title>t</title></head><body class='menu'><article>a</article></body>", "a"),
    ("<article>1 < 2 &am &amp &notit; <3</article>", "1 < 2 &am & ¬it; <3"),
    ("<article>a<!-- no <p>x</p> --><!-->b</article>", "ab"),
    ("<article>kept <a href='unfinished", "kept"),
    ("<article><p title='a > b' data-x=1 it's>q</p></article>", "q"),
    ("<article><p>a</p></div></nav></p><p>b</p></article>", "a b"),
    ("<ARTICLE>A B&nbsp;C D</ARTICLE>", "A B C D"),
    ("<div role=navigation>n</div><div role=main>m</div>", "m"),
    ("<article>say <span class='ad'>buy</span> it</article>", "say it"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1 2 3"),
    ("<article><ul><li class=ad>x<li>y<ul><li>z</ul></ul></article>", "y z"),
    ("<article><textarea><p>t</textarea><noscript>n</noscript>v</article>", "v"),
    ("<article><script>never closed", ""),
])
def test_regions(page, expected):
    assert text(page) == expected


def test_odd_markup_takes_linear_time():
    for piece in ("<b>", "<p class='", "<a \"", "</div>", "<!--", "<li>", "<article><nav>", "< ", "&amp"):
        page_text.page_blocks(piece * 50_000)
    assert text("<article>" + "<b>x " * 20_000 + "</article>") == " ".join(["x"] * 20_000)


def plain_gone(pages, run):
    """Open blocks with at least half of their words in windows that another page of the host has."""
    places = defaultdict(set)
    streams = {}
    for row, (host, blocks) in enumerate(pages):
        stream, spans = [], []
        for k, (role, words) in enumerate(b for b in blocks if b[0] != page_text.MAIN):
            spans.append((role, len(stream), len(stream) + len(words)))
            stream += words
        streams[row] = host, stream, spans
        for i in range(len(stream) - run + 1):
            places[host, tuple(stream[i:i + run])].add(row)
    out = []
    for row, (host, stream, spans) in streams.items():
        covered = set()
        for i in range(len(stream) - run + 1):
            if len(places[host, tuple(stream[i:i + run])]) > 1:
                covered.update(range(i, i + run))
        out.append([role == page_text.OPEN and 2 * sum(i in covered for i in range(a, b)) >= b - a for role, a, b in spans])
    return out


@pytest.mark.parametrize("chunk", [40, 400, 1 << 20])
def test_repeated_runs_against_a_plain_search(spark, monkeypatch, chunk):
    monkeypatch.setattr(page_text, "CHUNK", chunk)
    draw = np.random.default_rng(5)
    shared = [" ".join(f"s{i}w{draw.integers(0, 6)}" for _ in range(int(draw.integers(2, 14)))) for i in range(8)]
    rows, pages = [], []
    for i in range(120):
        host = ["big.example", "big.example", "a.example", "b.example", f"h{i % 9}.example"][i % 5]
        parts = [shared[draw.integers(0, 8)] if draw.random() < 0.6 else " ".join(f"u{i}x{draw.integers(0, 50)}" for _ in range(int(draw.integers(1, 12))))
                 for _ in range(int(draw.integers(0, 5)))]
        tags = ["div" if draw.random() < 0.8 else "footer" for _ in parts]
        rows.append((i // 2, f"http://{host}/{i}", "".join(f"<{t}>{p}</{t}>" for t, p in zip(tags, parts))))
        pages.append((host, [(page_text.OPEN if t == "div" else page_text.ASIDE, p.split()) for t, p in zip(tags, parts)]))
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5).selectExpr(
        "*", "1 AS row", "'h' AS host", "2 AS side", "3 AS chunk", "4 AS `a.b`")
    found = {r["url"]: r["text"] for r in page_text.main_text(table, run=4).collect()}
    for (_, url, _), (_, blocks), gone in zip(rows, pages, plain_gone(pages, 4)):
        assert found[url] == " ".join(" ".join(w) for (role, w), g in zip(blocks, gone) if role == page_text.OPEN and not g)


def test_odd_rows(spark):
    long_page = "<article>" + "<p>word</p>" * 100_000 + "</article>"
    rows = [(1, None, None), (None, "http://a.example/x", ""), (2, "no url", "<p>one</p>"), (3, "http://u@A.example:80/", "<article>é\U0001f642</article>"),
            (4, "http://a.example", long_page), (5, "http://a.example", "<article>same</article>"), (5, "http://a.example", "<article>same</article>")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = sorted(((r["page_id"] or 0), r["url"], len(r["text"])) for r in page_text.main_text(table).collect() if r["url"])
    assert found == sorted((p or 0, u, n) for (p, u, _), n in zip(rows[1:], [0, 3, 2, 499_999, 4, 4]))
    assert [r["text"] for r in page_text.main_text(table.where("page_id = 1")).collect()] == [""]
    assert page_text.main_text(table.limit(0)).count() == 0


def test_article_copies_stay(spark):
    page = "<div>" + "menu entry " * 20 + "</div><article>" + "the same long story " * 30 + "</article>"
    table = spark.createDataFrame([(i, "http://a.example/", page) for i in range(5)], "page_id long, url string, html string")
    assert {r["text"] for r in page_text.main_text(table).collect()} == {("the same long story " * 30).strip()}
    assert re.search("menu", page)


@pytest.mark.parametrize("page, expected", [
    ("<body><form id='aspnetForm'><input><nav>n</nav><div><article><p>a</p><form>f</form></article></div>g</form></body>", "a"),
    ("<form><main><p>m</p></main></form>", "m"),
    ("<main><form><article>a</article></form></main>", "a"),
    ("<nav><form><article>n</article></form></nav><article><form><article>reply</article></form>a</article>", "a"),
    ("<form class='newsletter'><article>n</article></form><form><aside><article>s</article></aside></form><article>a</article>", "a"),
    ("<html><head><meta charset=utf-8><title>t</title><script>s</script><body class=x><article>a</article>", "a"),
    ("<head><title>t</title>\n<article>a</article>", "a"),
    ("<head><style>s</style>plain <b>words</b>", "plain words"),
])
def test_what_surrounds_an_article_leaves_it_whole(page, expected):
    assert text(page) == expected


def plain_gone_beside_main(pages, run):
    """Open blocks with at least half of their words in windows of two pages of the host, and in none of its main texts."""
    def spans(stream, chosen):
        return {k for i in range(len(stream) - run + 1) if chosen(tuple(stream[i:i + run])) for k in range(i, i + run)}

    places, main = defaultdict(set), set()
    outside = [[w for role, words in blocks if role != page_text.MAIN for w in words] for _, blocks in pages]
    for row, (host, blocks) in enumerate(pages):
        inside = [w for role, words in blocks if role == page_text.MAIN for w in words]
        main.update((host, tuple(inside[i:i + run])) for i in range(len(inside) - run + 1))
        for i in range(len(outside[row]) - run + 1):
            places[host, tuple(outside[row][i:i + run])].add(row)
    out = []
    for (host, blocks), stream in zip(pages, outside):
        covered = spans(stream, lambda w: len(places[host, w]) > 1) - spans(stream, lambda w: (host, w) in main)
        gone, at = [], 0
        for role, words in blocks:
            size = len(words) if role != page_text.MAIN else 0
            gone.append(role == page_text.OPEN and 2 * sum(k in covered for k in range(at, at + size)) >= size)
            at += size
        out.append(gone)
    return out


@pytest.mark.parametrize("buckets", [1, 1 << 16])
@pytest.mark.parametrize("chunk", [40, 400, 1 << 20])
def test_repeated_runs_beside_main_texts_against_a_plain_search(spark, monkeypatch, chunk, buckets):
    monkeypatch.setattr(page_text, "CHUNK", chunk)
    monkeypatch.setattr(page_text, "BUCKETS", buckets)
    draw = np.random.default_rng(11)
    shared = [" ".join(f"s{i}w{draw.integers(0, 6)}" for _ in range(int(draw.integers(2, 14)))) for i in range(10)]
    rows, pages = [], []
    for i in range(150):
        host = ["big.example", "big.example", "a.example", "b.example", f"h{i % 9}.example"][i % 5]
        article = host != "b.example" and draw.random() < 0.4
        parts = [shared[draw.integers(0, 10)] if draw.random() < 0.6 else " ".join(f"u{i}x{draw.integers(0, 50)}" for _ in range(int(draw.integers(1, 12))))
                 for _ in range(int(draw.integers(0, 5)))]
        tags = ["footer" if draw.random() < 0.2 else "article" if article and draw.random() < 0.6 else "div" for _ in parts]
        article = "article" in tags
        roles = [page_text.MAIN if t == "article" else page_text.OPEN if t == "div" and not article else page_text.ASIDE for t in tags]
        rows.append((i, f"http://{host}/{i}", "".join(f"<{t}>{p}</{t}>" for t, p in zip(tags, parts))))
        pages.append((host, [(r, p.split()) for r, p in zip(roles, parts)]))
    plain = plain_gone_beside_main(pages, 4)
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    found = {r["page_id"]: r["text"] for r in page_text.main_text(table, run=4).collect()}
    for (i, _, _), (_, blocks), gone in zip(rows, pages, plain):
        assert found[i] == " ".join(" ".join(w) for (role, w), g in zip(blocks, gone) if role != page_text.ASIDE and not g)
    without = plain_gone([(host, [b for b in blocks if b[0] != page_text.MAIN]) for host, blocks in pages], 4)
    assert sum(map(sum, plain)) < sum(map(sum, without))


def test_an_articles_words_are_main_text_on_pages_without_article(spark):
    story, notice = "the long story of one page and its plain copies " * 5, "this site asks all of its readers to agree with it"
    pages = [f"<div>{notice}</div><article><p>{story}</p></article>", *[f"<div>{notice}</div><div>{story}</div><div>{k}</div>" for k in "xy"]]
    table = spark.createDataFrame([(k, f"http://{host}/{k}", page) for host in ("a.example", "b.example") for k, page in enumerate(pages)
                                   if host == "a.example" or k], "page_id long, url string, html string")
    found = {(r["url"]): r["text"] for r in page_text.main_text(table).collect()}
    assert found == {"http://a.example/0": story.strip(), "http://a.example/1": f"{story}x", "http://a.example/2": f"{story}y",
                     "http://b.example/1": "x", "http://b.example/2": "y"}
