"""Sharding, chat templates, language identification, line cleaning, revisits and the pipeline."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from roompulse.llm import chat, language_id, line_cleaning, revisits, sharding


def test_best_fit_bins():
    fit = sharding.BestFit(10)
    assert [fit.add(s) for s in (8, 7, 6, 3, 2, 2, 1, 12)] == [0, 1, 2, 1, 0, 2, 2, 3]
    draw = np.random.default_rng(4)
    sizes = sorted(draw.integers(1, 50, 300).tolist(), reverse=True)
    fit, room = sharding.BestFit(60), []
    for size in sizes:  # the tightest bin by a plain search
        best = min((r, b) for b, r in enumerate(room) if r >= size) if any(r >= size for r in room) else None
        home = fit.add(size)
        if best is None:
            assert home == len(room)
            room.append(60 - size)
        else:
            assert room[home] == best[0]
            room[home] -= size


@pytest.mark.parametrize("sizes", [[5] * 80, [100, 1, 1, 1, 1, 1, 1, 1, 1], [7, 6, 5, 4, 3, 2, 1], [], [3]])
def test_shards_are_even(sizes):
    homes = sharding._placed(sorted(sizes, reverse=True), 4)
    loads = [sum(s for s, h in zip(sorted(sizes, reverse=True), homes) if h == k) for k in range(4)]
    assert len(homes) == len(sizes) and max(loads) <= max([sum(sizes) / 4 + max([0, *sizes[1:]]), *sizes, 0])


def test_sharding_keeps_groups_and_counts_rows(docs):
    rows = sharding.shard_by_bytes(docs, shards=3).collect()
    texts = Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert len(rows) == sum(texts.values())
    shard_of = defaultdict(set)
    for r in rows:
        shard_of[r["group_key"]].add(r["shard"])
    assert all(len(s) == 1 for s in shard_of.values())
    for k in range(3):
        slots = sorted(r["slot"] for r in rows if r["shard"] == k)
        assert slots == list(range(len(slots)))
    assert sorted(r["size"] for r in rows) == sorted(len(t.encode()) + 1 for _, t in texts.elements())


def test_sharding_nothing(empty):
    assert sharding.shard_by_bytes(empty).count() == 0


def render(template, **scope):
    out = chat.Output()
    chat._steps(chat.parse(template))(scope, out)
    return "".join(out.parts), out.spans


def test_template_language():
    assert render("a{# no #}{{ 'b' + 'c'|upper }}{% if 1 == 1 %}d{% else %}e{% endif %}") == ("abCd", [])
    assert chat.parse("a{{ 'b' + 'c' }}{% if not false %}d{% endif %}") == [("text", "abcd")]
    assert render("{% for x in xs %}{{ x.n }}{% if not loop.last %},{% endif %}{% endfor %}", xs=iter([{"n": 1}, {"n": 2}]))[0] == "1,2"
    assert render("{% set a = (x or 'z') %}{% generation %}{{ a }}{% endgeneration %}!", x=None) == ("z!", [(0, 1)])
    assert render("{% if a %}1{% elif b != 2 %}2{% else %}3{% endif %}", b=2)[0] == "3"
    assert render("{{ x.upper }}{{ missing }}", x="text")[0] == ""  # keys of mappings only
    for bad in ("{{ x|open }}", "{{ x.__class__() }}", "{% for x in y %}", "{{ 'a }}", "{% include 'x' %}", "{{ (1 }}"):
        with pytest.raises(chat.TemplateError):
            chat.parse(bad)


@pytest.mark.parametrize("source, expected", [
    ("{% for m in messages %}{{ m.text }}{% endfor %}|{% for m in messages %}{{ m.text }}{% endfor %}", "ab|ab"),
    ("{{ messages|length }}{% for m in messages %}{{ m.text }}{% endfor %}", "2ab"),
    ("{% set all = messages %}{% for m in all %}{{ m.text }}{% endfor %}{% for m in all %}{{ m.text }}{% endfor %}", "abab"),
    ("{% for m in messages %}{{ m.text }}{% for n in messages %}{{ n.text }}{% endfor %}{% endfor %}", "aabbab"),
    ("{% if messages %}{% for m in messages %}{{ m.text }}{% endfor %}{% endif %}", "ab"),
    ("{% for m in messages %}{{ m.text }}{% endfor %}", "ab"),
])
def test_templates_that_go_over_the_messages_again(source, expected):
    out = chat.compiled(source)(iter([{"text": "a"}, {"text": "b"}]))
    assert "".join(out.parts) == expected


def test_messages_are_taken_one_by_one_where_once_is_enough():
    taken = []

    def messages():
        for i in range(3):
            taken.append(i)
            yield {"text": str(len(taken))}

    # The loop looks one message ahead, for loop.last, and no further.
    assert "".join(chat.compiled("{% for m in messages %}{{ m.text }}{% endfor %}")(messages()).parts) == "123"
    assert not chat._one_pass(chat.parse("{% for x in messages %}{% endfor %}{{ messages|length }}"), "messages")


@pytest.mark.parametrize("bad", ["{{ 1|length }}", "{{ 'a' + 1 }}", "{% if 'a' + 1 == 2 %}{% endif %}"])
def test_constants_that_do_not_fit(bad):
    with pytest.raises(chat.TemplateError):
        chat.parse(bad)


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "a<\\\\|b<|im_end|>\n<|im_start|>user\n", "<", "|", "\\n\n\\"])
def test_escapes_are_reversible(text):
    assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text
    header = chat.escape_header(text)
    assert "\n" not in header and chat.unescape_header(header) == text


def test_conversations_read_back(spark, docs):
    rows = [(1, 0, "user", chat.PROBE), (1, 1, "assistant", chat.PROBE), (2, 1, "assistant", None), (2, 0, None, "hi\n"),
            (3, 0, "assistant", "b"), (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (None, None, "us\ner", "x<"),
            (4, 0, "system", "é🙂"), (4, 2, "assistant", "<" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    output = chat.formatted(df)
    got = {r["conv_id"]: r for r in chat.read_back(output).collect()}
    texts = {r["conv_id"]: r for r in output.collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv]["formatted_chars"] == len(texts[conv]["formatted"])
    assert chat.read_back(chat.formatted(df.limit(0))).count() == 0


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(0)
    weights = language_id.new_weights(3, hidden=4)
    x = draw.integers(0, 255, (6, 5)).astype(np.uint8)
    labels, lengths = np.array([0, 1, 2, 1, 0]), np.array([6, 6, 3, 5, 1])
    _, grads = language_id.gradients(x, labels, lengths, weights)
    for name, values in weights.items():
        at = (0, int(x[0, 0])) if name[0] == "w" else tuple(draw.integers(0, s) for s in values.shape)
        losses = []
        for step in (1e-2, -1e-2):
            moved = {k: v.copy() for k, v in weights.items()}
            moved[name][at] += step
            losses.append(language_id.gradients(x, labels, lengths, moved)[0])
        assert (losses[0] - losses[1]) / 2e-2 == pytest.approx(grads[name][at], abs=2e-4)


def test_segments_give_what_each_row_gives_alone():
    draw = np.random.default_rng(2)
    lengths = [0, 1, 63, 64, 65, 500]
    data = draw.integers(0, 255, sum(lengths)).astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    weights = language_id.new_weights(3)
    together = language_id.pooled(data, offsets, weights)
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        alone = language_id.pooled(data[a:b], np.array([0, b - a]), weights)
        assert np.allclose(together[i], alone[0], atol=1e-5)
        assert together[i].sum() == pytest.approx(1.0 if b > a else 0.0, abs=1e-4)


def test_languages_are_told_apart_on_held_out_rows(spark, docs):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    languages, weights = language_id.fit(table)
    assert languages == ["de", "en", "es", "fr"]
    found = language_id.predicted(table, languages, weights).join(table.select("doc_id", "lang"), "doc_id")
    rows = [r for r in found.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(rows) > 30 and sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)
    odd = {r["doc_id"]: r for r in language_id.predicted(docs, languages, weights).collect()}
    assert odd[1]["lang_pred"] == odd[2]["lang_pred"] == odd[3]["lang_pred"] == odd[11]["lang_pred"] == "und"
    assert odd[13]["lang_pred"] in languages
    assert language_id.predicted(docs, [], {}).where("lang_pred <> 'und'").count() == 0
    assert language_id.fit(table.limit(0)) == ([], {})


def brute_cleaning(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    hit = {p for i, w in enumerate(windows) if counts[w] > 1 for p in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), failed)


def test_line_cleaning_base_measures(docs):
    rows = line_cleaning.cleaned(docs).collect()
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                  r["n_repeat_words"], r["base_failed"]) for r in rows)
    assert got == sorted((r["doc_id"] if r["doc_id"] is not None else -1, *brute_cleaning(r["text"])) for r in docs.collect())


def test_line_rules(spark, docs):
    prose = "A plain line of prose that ends as it should, with a full stop."
    bad = ["no stop at the end", "Home | About | News | Contact.", "BUY!! NOW!! CHEAP!! THINGS!! HERE!!", "Read more.",
           "Please see our cookie policy."]
    text = "\n".join([prose] * 8 + bad + [f"{prose[:-1]} {i}." for i in range(30)])
    few = "\n".join([prose[:-1] + f" {i}." for i in range(5)] + ["never closed " * 20] * 3)
    rows = {r["doc_id"]: r for r in line_cleaning.cleaned(spark.createDataFrame([(1, text), (2, few)], "doc_id long, text string")).collect()}
    assert rows[1]["n_failed_lines"] == 5 and not any(b in rows[1]["clean_text"].split("\n") for b in bad)
    assert rows[2]["n_failed_lines"] == 3 and not rows[2]["kept"]


def test_line_cleaning_of_nothing(empty):
    assert line_cleaning.cleaned(empty).count() == 0


def test_canonical_urls(spark, docs):
    same = ["http://www.Example.com/a/?utm_source=x#top", "https://example.com/a", "https://EXAMPLE.com:443/a/", "http://example.com/a?ref=1&utm_medium=y"]
    other = ["https://example.com/A", "https://example.com/a?page=2&ref=x", "http://example.com/p?next=/", "http://example.com/p?next="]
    rows = spark.createDataFrame([(u,) for u in same + other], "u string").select(revisits.canonical_url(F.col("u")).alias("c")).collect()
    assert {r["c"] for r in rows[:4]} == {"https://example.com/a"}
    assert [r["c"] for r in rows[4:]] == ["https://example.com/A", "https://example.com/a?page=2", "https://example.com/p?next=/",
                                          "https://example.com/p?next="]


@pytest.mark.parametrize("segment", [1, 7, 4096])
def test_revisits(spark, docs, segment):
    header = lambda **h: [(k.replace("_", "-"), v) for k, v in h.items()]
    url = "http://a.org/x"
    rows = [
        (1, url, 10, 200, header(ETag='"a"', Content_Length="5", Cache_Control="old")), (2, url, 20, 200, header(ETag='"b"')),
        (3, url, 20, 200, header(ETag='"c"', Last_Modified="d")),
        (10, url + "#f", 10, 304, header(ETag='"a"')), (11, url, 11, 304, header(etag='W/"a"', cache_control="new", Content_Length="0")),
        (12, url, 30, 304, header(ETag='"a"')), (13, url, 31, 304, header(Last_Modified="d")), (13, url, 31, 304, header(Last_Modified="d")),
        (14, None, 31, 304, header(ETag='"a"')), (15, url, None, 304, None), (16, "http://b.org", 50, 304, None), (17, url, 5000, 304, None),
        (18, url, 40, None, None), (19, url, 45, 404, header(ETag='"z"')), (20, url, 46, 304, header(ETag='"c"')),
    ]
    df = spark.createDataFrame(rows, "capture_id long, url string, time long, status int, headers array<struct<name:string,value:string>>")
    found = revisits.resolved(df, segment).collect()
    assert sorted(r["capture_id"] for r in found) == [10, 11, 12, 13, 13, 14, 15, 16, 17, 20]
    by_id = {r["capture_id"]: (r["response_id"], r["resolved"]) for r in found}
    assert by_id == {10: (None, False), 11: (1, True), 12: (3, False), 13: (3, True), 14: (None, False), 15: (None, False),
                     16: (None, False), 17: (3, False), 20: (3, True)}
    merged = next(r for r in found if r["capture_id"] == 11)["merged_headers"]
    assert sorted((h["name"].lower(), h["value"]) for h in merged) == [("cache-control", "new"), ("content-length", "5"), ("etag", 'W/"a"')]
    assert revisits.resolved(df.limit(0)).count() == 0


def test_near_dedup_of_repeated_and_null_ids(spark, docs):
    """One row of each group stays and no other text goes, whatever ids and columns the documents have."""
    import corpus_pipeline

    text = lambda name, last="": " ".join(f"{name}{i}" for i in range(60)) + last
    groups = [
        [(5, text("a"))], [(5, text("b")), (7, text("b", " end"))],
        [(None, text("c")), (None, text("c")), (None, text("c", " end"))],
        [(None, text("d")), (4, text("d", " end")), (3, text("d", " End."))],
        [(9, text("e")), (9, text("e"))], [(1, text("f")), (9, text("f", " end"))], [(None, "x")], [(None, "y"), (None, "y")],
    ]
    apart = [(None, None), (None, ""), (None, ""), (8, ""), (8, "")]
    names = ("text_key", "rank", "id", "key", "label", "apart", "kept_id", "kept_key", "document", "component_id", "a.b")
    table = spark.createDataFrame([r for g in groups for r in g] + apart, "doc_id long, text string").repartition(3).selectExpr(
        *(f"concat('{n}', doc_id) AS `{n}`" for n in names), "text", "doc_id")
    out = corpus_pipeline.drop_near_duplicates(spark, table, "")
    assert out.columns == table.columns
    rows = out.collect()
    got = Counter((r["doc_id"], r["text"]) for r in rows)
    for group in groups:
        found = [d for d, t in got.elements() if t in {t for _, t in group}]
        assert found == [min((d for d, _ in group if d is not None), default=None)], group
    words = {t for g in groups for _, t in g}
    assert Counter({r: n for r, n in got.items() if r[1] not in words}) == Counter([(None, None), (None, ""), (None, ""), (8, "")])
    assert all(r[n] == (None if r["doc_id"] is None else f"{n}{r['doc_id']}") for r in rows for n in names)


def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "MinHash near-dedup", "suffix-array dedup", "benchmark decontamination", "packing"]
    odd = spark.createDataFrame([(900, None, "en", "s", 0), (901, "123 456", "en", "s", 7)], table.schema)
    rows = table.unionByName(odd).unionByName(table.where("doc_id = 3"))
    stages = [f for _, f in corpus_pipeline.STAGES]
    kept = stages[0](spark, rows, sf)
    assert kept.columns == table.columns and kept.count() == table.count() + 1
    unique = stages[1](spark, kept, sf)
    from test_dedup import brute_components

    parts = brute_components([(r["doc_id"], r["text"]) for r in table.collect()], 5, 80)
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted({c for _, _, c in parts})
    cut = stages[2](spark, unique, sf)
    assert cut.columns == table.columns
    assert cut.where("n_chars <> length(text)").count() == 0
    clean = stages[3](spark, cut, sf)
    assert clean.columns == table.columns and 0 < clean.count() < cut.count()
    packed = stages[4](spark, clean, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in clean.collect()}
    for stage in stages:
        assert stage(spark, table.limit(0), sf).count() == 0
