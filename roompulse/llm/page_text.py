"""Main text of web pages: regions by markup, and a suffix array per host for what markup doesn't tell.

A page's blocks are found in one pass over its tags. Text in an article (or, without one, in a main element) is main
text; scripts, styles, forms and elements that are menus, headers, footers, sidebars, notices, adverts or reader comments by their
name, role, class or id are not; a header inside an article gives its headings. On a page without article and main
element every other block is open. A form doesn't take an article or main element in it away, and a head without end
tag ends where the body's content begins.

Open blocks are decided by repetition. A page has two token streams, the words of its main text and those of all other
blocks. The streams of a host's pages are concatenated, their suffixes sorted by prefix doubling, and neighbours that share
``RUN`` tokens or more cover what they share. What other blocks of different pages share is boilerplate, unless it stands
in the main text of a page as well: a page without article that carries an article's words carries main text. An open
block with at least half of its words in boilerplate goes; the others stay. Main text is searched on hosts with open
blocks (and those that share a bucket of host hashes with one): elsewhere nothing is left to decide.

Pages are range-sorted by host, so one host can fill many tasks; a task holds at most ``CHUNK`` tokens (or one page) at a
time. What repeats only between such chunks is found through digests of the windows of hosts that touch a chunk's border,
one per distinct window and chunk, combined before the shuffle.

Character references are decoded, white space (Unicode's) in a block becomes one space, and blocks are joined by one space
in page order. NULL and empty pages have the empty text; a tag that never ends takes the rest of the page with it; an
unclosed element ends with its page. Rows are handled one by one, also with equal ids or copies of pages: the page of
a repeated run is a row. A NULL url, or one without a host, is the host ''. Other columns are left aside.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm import bytetext
from roompulse.llm.storage import mapped, saved

RUN = 8
CHUNK = 1 << 20
BUCKETS = 1 << 16

MAIN, OPEN, ASIDE = 0, 1, 2
_NO_CONTENT = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr".split())
#: Elements whose content is no markup: only their own end tag ends them.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_ASIDE_TAGS = frozenset("head nav header footer aside form script style textarea title xmp iframe noembed noframes noscript template "
                        "button select option object svg canvas audio video dialog menu".split())
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs header masthead footer sidebar aside cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended comment comments disqus replies search "
    "toolbar pagination pager widget".split())
#: Ends of other elements don't reach out of these.
_SECTIONS = frozenset("article main nav header footer aside form body html head table".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that don't end a head.
_HEAD_TAGS = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())

_MARKUP = re.compile(
    r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))"""
    r"""|(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?+|=)*+)(?P<close>>|\Z)"""
    r"""|[!?/][^>]*+(?:>|\Z))""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""")
_NAME = re.compile(r"[a-z0-9]+")


def _named_aside(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether role, class or id make an element an aside, and whether they make it the main text."""
    aside = main = False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape("".join(values)).lower()
        if name == "role":
            aside |= value.strip() in _ASIDE_ROLES
            main |= value.strip() in ("main", "article")
        elif name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            aside |= not _ASIDE_NAMES.isdisjoint(_NAME.findall(value))
        elif name == "itemprop":
            main |= "articlebody" in value.split()
    return aside, main


def page_blocks(page: str) -> list[tuple[int, str]]:
    """The blocks of a page in order: MAIN, OPEN or ASIDE, and the text."""
    found: list[list] = []  # [rank of the main region (2 article, 1 main, 0 none), aside, text]
    words: list[str] = []
    opened: list[tuple[str, int, bool, bool, bool]] = []  # tag, main rank, aside, headings only, aside by a form alone
    last: dict[str, list[int]] = {}
    walls: list[int] = []
    rank, aside, headings, formed = 0, False, False, False

    def close_block() -> None:
        text = " ".join(html.unescape("".join(words)).split())
        words.clear()
        if text:
            found.append([rank, aside, text])

    def pop_to(depth: int) -> None:
        nonlocal rank, aside, headings, formed
        while len(opened) > depth:
            tag = opened.pop()[0]
            last[tag].pop()
            if walls and walls[-1] == len(opened):
                walls.pop()
        _, rank, aside, headings, formed = opened[-1] if opened else ("", 0, False, False, False)

    at, size = 0, len(page)
    while at < size:
        sign = page.find("<", at)
        if sign < 0:
            sign = size
        if sign > at:
            if opened and opened[-1][0] == "head" and not page[at:sign].isspace():
                pop_to(len(opened) - 1)
            words.append(page[at:sign])
        if sign == size:
            break
        match = _MARKUP.match(page, sign)
        if match is None:
            words.append("<")
            at = sign + 1
            continue
        at = match.end()
        if match["tag"] is None:
            continue
        if not match["close"]:  # the page ends within a tag
            break
        tag = match["tag"].lower()
        if tag not in _INLINE:
            close_block()
        if match["end"]:
            places = last.get(tag)
            if places and (tag in _SECTIONS or not walls or places[-1] > walls[-1]):
                if tag in _INLINE and aside and not (places[-1] and opened[places[-1] - 1][2]):
                    close_block()
                pop_to(places[-1])
            continue
        if opened and opened[-1][0] == "head" and tag not in _HEAD_TAGS:
            pop_to(len(opened) - 1)
        if tag in _NO_CONTENT:
            continue
        if tag not in _INLINE and last.get("p") and (not walls or last["p"][-1] > walls[-1]):
            pop_to(last["p"][-1])
        if tag in ("li", "dd", "dt", "option", "tr", "td", "th") and last.get(tag):
            holder = max((last[t][-1] for t in ("ul", "ol", "dl", "select", "table", "tr") if last.get(t) and t != tag), default=-1)
            if last[tag][-1] > max(holder, walls[-1] if walls else -1):
                pop_to(last[tag][-1])
        named, main = _named_aside(tag, match["attributes"]) if match["attributes"] else (False, False)
        own = 2 if tag == "article" or main and tag != "main" else 1 if tag == "main" else 0
        in_article = rank == 2 and not aside
        if tag in _INLINE and named and not aside:
            close_block()
        form = not named and (formed or tag == "form" and not aside) and (tag == "form" or tag not in _ASIDE_TAGS)
        state = (max(rank, own), aside or tag in _ASIDE_TAGS or named, headings, form)
        if tag == "header" and in_article and not named:
            state = (rank, True, True, False)
        elif headings and tag in _HEADINGS and not named:
            state = (rank, False, False, False)
        elif form and own > rank:
            state = (own, False, False, False)
        if tag in _SECTIONS:
            walls.append(len(opened))
        last.setdefault(tag, []).append(len(opened))
        opened.append((tag, *state))
        rank, aside, headings, formed = state
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            at = end.start() if end else size
    close_block()
    best = max((r for r, a, _ in found if not a), default=0)
    return [(ASIDE if a or r < best else MAIN if best else OPEN, text) for r, a, text in found]


_PARSED = "row long, page_id long, url string, host string, undecided boolean, blocks array<struct<role: int, text: string>>"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = pa.struct([("role", pa.int32()), ("text", pa.string())])
    for batch in batches:
        blocks = [[{"role": role, "text": text} for role, text in page_blocks(page or "")] for page in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["row"], batch["page_id"], batch["url"], batch["host"],
             pa.array([any(b["role"] == OPEN for b in page) for page in blocks], pa.bool_()), pa.array(blocks, pa.list_(block))],
            names=["row", "page_id", "url", "host", "undecided", "blocks"])


def window_classes(tokens: np.ndarray, hosts: np.ndarray, pages: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of ``run`` tokens within pages, and their classes: equal for equal windows of a host.

    Suffixes are sorted by prefix doubling: a suffix's rank by its first 2k tokens is that of the pair of its
    rank by the first k and the rank of the suffix k further on.
    """
    size = len(tokens)
    ends = np.append(np.flatnonzero(pages[1:] != pages[:-1]) + 1, size) if size else np.empty(0, np.int64)
    room = np.repeat(ends, np.diff(np.append(0, ends))) - np.arange(size)
    rank = np.unique(tokens, return_inverse=True)[1].reshape(-1)
    rank = np.unique(hosts * (size + 1) + rank, return_inverse=True)[1].reshape(-1)
    length = 1
    while length < run:
        step = min(length, run - length)
        fits = np.flatnonzero(room >= length + step)
        new = np.full(size, -1)
        new[fits] = np.unique(rank[fits] * (size + 1) + rank[fits + step], return_inverse=True)[1].reshape(-1)
        rank, length = new, length + step
    starts = np.flatnonzero(room >= run)
    return starts, rank[starts]


def _digests(tokens: np.ndarray, starts: np.ndarray, run: int) -> np.ndarray:
    digest = np.zeros(len(starts), np.uint64)
    for k in range(run):
        digest = bytetext.mix(digest * np.uint64(0x9E3779B97F4A7C15) + tokens[starts + k].view(np.uint64))
    return digest.view(np.int64)


_RUNS = ("row long, host string, chunk long, spans array<struct<at: int, first: int, last: int>>, hits array<int>, known array<int>, "
         "asked array<struct<start: int, digest: long>>, shown array<long>, main array<long>")


def _firsts(at: np.ndarray, classes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which of the chosen windows are the first ones of their class."""
    first = np.full(int(classes.max(initial=-1)) + 1, -1)
    first[classes[chosen][::-1]] = at[chosen][::-1]
    return chosen & (first[classes] == at)


def _chunk_rows(chunk: int, tables: list[pa.Table], run: int) -> pa.RecordBatch:
    """What repeats and what is main text within one chunk of pages, and the digests for the hosts at its borders."""
    table = pa.concat_tables(tables)
    side = table["side"].combine_chunks()
    flat, per_page = side.flatten(), side.value_lengths().fill_null(0).to_numpy()
    data, offsets = bytetext.utf8(flat.field("text"))
    starts, ends, first = bytetext.words(data, offsets)
    tokens = bytetext.span_hashes(data, starts, ends).view(np.int64) if len(starts) else np.empty(0, np.int64)
    block_first = np.append(0, np.cumsum(per_page))
    page_first = first[block_first]
    role = flat.field("role").to_numpy(zero_copy_only=False)
    block_page = np.repeat(np.arange(len(per_page)), per_page)
    # A page's blocks outside the main text come first: stream 2k, and 2k + 1 for the main text.
    streams = np.repeat(2 * block_page + (role == MAIN), np.diff(first))
    names = table["host"].combine_chunks().dictionary_encode()
    codes = names.indices.to_numpy().astype(np.int64)
    at, classes = window_classes(tokens, codes[streams >> 1], streams, run)
    pages, main = streams[at] >> 1, streams[at] % 2 == 1
    has_open = np.bincount(block_page, role == OPEN, len(per_page)) > 0
    border = {codes[0], codes[-1]}
    least, most, in_main = (np.zeros(int(classes.max(initial=-1)) + 1, np.int64) for _ in range(3))
    least[classes[~main][::-1]] = pages[~main][::-1]
    most[classes[~main]] = pages[~main]
    in_main[classes[main]] = 1
    digests = _digests(tokens, at, run)
    hit, known = ~main & (least < most)[classes], ~main & (in_main > 0)[classes]
    on_border = np.isin(codes[pages], list(border)) if len(at) else np.zeros(0, bool)
    asked = ~main & on_border & has_open[pages] & ~(hit & known)
    shown = _firsts(at, classes, ~main & on_border) & (hit | ~has_open[pages])
    shown_main = _firsts(at, classes, main & on_border)
    bounds = np.searchsorted(at, page_first)
    out: dict[str, list] = {"spans": [], "hits": [], "known": [], "asked": [], "shown": [], "main": []}
    for page in range(len(per_page)):
        a, b, base = bounds[page], bounds[page + 1], page_first[page]
        mine = slice(a, b)
        begin = block_first[page]
        open_blocks = [k for k in range(begin, block_first[page + 1]) if role[k] == OPEN]
        out["spans"].append([{"at": int(k - begin), "first": int(first[k] - base), "last": int(first[k + 1] - base)} for k in open_blocks])
        out["hits"].append((at[mine][hit[mine]] - base).tolist() if open_blocks else [])
        out["known"].append((at[mine][known[mine]] - base).tolist() if open_blocks else [])
        out["asked"].append([{"start": s, "digest": d} for s, d in
                             zip((at[mine][asked[mine]] - base).tolist(), digests[mine][asked[mine]].tolist(), strict=True)])
        out["shown"].append(digests[mine][shown[mine]].tolist())
        out["main"].append(digests[mine][shown_main[mine]].tolist())
    span = pa.struct([("at", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])
    return pa.RecordBatch.from_arrays([
        table["row"].combine_chunks(), table["host"].combine_chunks(), pa.array(np.full(len(per_page), chunk)),
        pa.array(out["spans"], pa.list_(span)), pa.array(out["hits"], pa.list_(pa.int32())), pa.array(out["known"], pa.list_(pa.int32())),
        pa.array(out["asked"], pa.list_(pa.struct([("start", pa.int32()), ("digest", pa.int64())]))),
        pa.array(out["shown"], pa.list_(pa.int64())), pa.array(out["main"], pa.list_(pa.int64())),
    ], names=["row", "host", "chunk", "spans", "hits", "known", "asked", "shown", "main"])


def _covered(starts: list[int], size: int, run: int) -> np.ndarray:
    """Which of a page's words are in a window that starts at one of the places."""
    change = np.zeros(size + run + 1, np.int64)
    begins = np.unique(np.array(starts, np.int64))
    begins = begins[begins < size]
    np.add.at(change, begins, 1)
    np.add.at(change, begins + run, -1)
    return np.cumsum(change) > 0


def _boilerplate(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = []
        for spans, starts, known in zip(*(batch[name].to_pylist() for name in ("spans", "starts", "known")), strict=True):
            size = max(s["last"] for s in spans)
            covered = np.append(0, np.cumsum(_covered(starts, size, run) & ~_covered(known, size, run)))
            gone.append([s["at"] for s in spans if 2 * (covered[s["last"]] - covered[s["first"]]) >= s["last"] - s["first"]])
        yield pa.RecordBatch.from_arrays([batch["row"], pa.array(gone, pa.list_(pa.int32()))], names=["row", "gone"])


def repeated_blocks(pages: DataFrame, run: int = RUN) -> DataFrame:
    """For pages (row, host, undecided, blocks) with open blocks: the indexes of those that are boilerplate."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            first = 0
            for row, side in enumerate(batch["side"].to_pylist()):
                # A word has a byte at least, and white space between words another one.
                need = sum(len(s["text"]) // 2 + 1 for s in side or [])
                if size and size + need > CHUNK:
                    held.append(pa.Table.from_batches([batch.slice(first, row - first)]))
                    yield _chunk_rows(chunk, held, run)
                    chunk, held, size, first = chunk + 1, [], 0, row
                size += need
            held.append(pa.Table.from_batches([batch.slice(first)]))
        if sum(map(len, held)):
            yield _chunk_rows(chunk, held, run)

    # At most BUCKETS numbers, however many hosts there are: a host that shares another one's bucket is searched in vain.
    bucket = F.pmod(F.xxhash64("host"), F.lit(BUCKETS))
    undecided = F.broadcast(pages.where("undecided").select(bucket.alias("bucket")).distinct())
    side = F.concat(F.filter("blocks", lambda b: b["role"] != MAIN),
                    F.filter("blocks", lambda b: (b["role"] == MAIN) & F.col("bucket").isNotNull()))
    streams = pages.join(undecided, bucket == F.col("bucket"), "left").select("row", "host", side.alias("side"))
    ordered = streams.repartitionByRange("host", "row").sortWithinPartitions("host", "row")
    found = saved(ordered.transform(mapped, search, _RUNS), "host-runs")
    outside = found.select("host", "chunk", F.lit(False).alias("main"), F.explode(F.concat("shown", "asked.digest")).alias("digest"))
    inside = found.select("host", F.lit(None).cast("long").alias("chunk"), F.lit(True).alias("main"), F.explode("main").alias("digest"))
    between = outside.unionByName(inside).groupBy("host", "digest").agg(
        (F.min("chunk") < F.max("chunk")).alias("repeated"), F.max("main").alias("main")).where("repeated or main")
    opened = found.where(F.size("spans") > 0)
    asked = opened.select("row", "host", F.explode("asked").alias("window")).select("row", "host", "window.*")
    more = asked.join(between, ["host", "digest"]).groupBy("row").agg(
        F.collect_list(F.when(F.col("repeated"), F.col("start"))).alias("more"), F.collect_list(F.when(F.col("main"), F.col("start"))).alias("more_known"))
    none = F.array().cast("array<int>")
    rows = opened.join(more, "row", "left").select("row", "spans", F.concat("hits", F.coalesce("more", none)).alias("starts"),
                                                   F.concat("known", F.coalesce("more_known", none)).alias("known"))
    return rows.transform(mapped, lambda batches: _boilerplate(batches, run), "row long, gone array<int>")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", run: int = RUN) -> DataFrame:
    """page_id, url and main text of every page."""
    url = F.col(url_col).cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    named = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("page_id"), url.alias("url"),
                         host.alias("host"), F.col(html_col).alias("html"))
    parsed = saved(named.transform(mapped, _parse, _PARSED), "pages")
    gone = saved(repeated_blocks(parsed, run), "boilerplate")
    texts = F.transform("blocks", lambda b: F.when(b["role"] != ASIDE, b["text"]))
    rows = parsed.select("row", "page_id", "url", texts.alias("texts")).join(gone, "row", "left")
    kept = F.when(F.col("gone").isNull(), F.col("texts")).otherwise(
        F.filter("texts", lambda _, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i)))
    return rows.select("page_id", "url", F.array_join(kept, " ").alias("text"))


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    from roompulse.llm.storage import table

    return main_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


# Every page of the tables has one article, of plain markup.
OP12_SQL = r"""
WITH inside AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages
), bare AS (
  SELECT page_id, url, regexp_replace(regexp_replace(body, '</?(b|i|em|a|span)( [^>]*)?>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM inside
), decoded AS (
  SELECT page_id, url, regexp_replace(replace(replace(replace(replace(regexp_replace(t, '&amp([^;]|$)', '&amp;\1', 'g'),
    '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g') AS t
  FROM bare
)
SELECT page_id, url, trim(t) AS text, CAST(length(trim(t)) AS BIGINT) AS n_chars FROM decoded
"""
