"""Suffix-array dedup, near-duplicates and decontamination against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from roompulse.llm import chosen_path, decontaminate, suffix_dedup
from roompulse.llm.components import components


def brute_removed(rows, width):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    places = {}
    for i in order:
        data = (rows[i][1] or "").encode()
        for p in range(len(data) - width + 1):
            window = data[p:p + width]
            at = ((rows[i][0] is not None, rows[i][0] or 0), p)
            places[window] = min(places.get(window, at), at)
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - width + 1):
            if places[data[p:p + width]] < ((doc_id is not None, doc_id or 0), p):
                gone[p:p + width] = b"\1" * width
        out.append((doc_id if doc_id is not None else -1, len(data), sum(gone), bytes(b for b, g in zip(data, gone) if not g)))
    assert not seen
    return sorted(out)


def found_removed(df, **options):
    rows = suffix_dedup.repeats_removed(df, **options).collect()
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in rows)


def test_repeats_of_odd_rows(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found_removed(docs) == brute_removed(rows, 100)


@pytest.mark.parametrize("hot", [8192, 2])
@pytest.mark.parametrize("width", [40, 100])
def test_repeats_of_drawn_rows(spark, docs, monkeypatch, hot, width):
    """Few letters, planted passages, periodic texts; with a low limit every gram is dealt to several blocks."""
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", hot)
    draw = random.Random(width + hot)
    passages = ["".join(draw.choice("abcdé ") for _ in range(draw.randint(30, 260))) for _ in range(6)]
    rows = []
    for i in range(60):
        text = "".join(draw.choice([*passages, "".join(draw.choice("abcdefgh ") for _ in range(draw.randint(0, 90)))])
                       for _ in range(draw.randint(0, 5)))
        rows.append((i, text))
    rows += [(60, "ab" * 300), (61, "ab" * 200), (62, "a" * 250)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found_removed(df, width=width) == brute_removed(rows, width)


def test_bucket_pointers_sort_suffixes():
    draw = np.random.default_rng(1)
    for _ in range(20):
        width = int(draw.integers(3, 60))
        count = draw.integers(1, 40, 8)
        text = draw.integers(97, 99, int((count - 1 + width).sum())).astype(np.uint8)
        first = np.cumsum(count - 1 + width) - (count - 1 + width)
        windows = [text[f + k:f + k + width].tobytes() for f, c in zip(first, count) for k in range(c)]
        ranks = {w: i for i, w in enumerate(sorted(set(windows)))}
        assert suffix_dedup.suffix_buckets(text, first, count, width).tolist() == [ranks[w] for w in windows]


@pytest.mark.parametrize("letters", [1, 2, 90, 256])
def test_bucket_pointers_with_any_letters(letters):
    draw = np.random.default_rng(letters)
    count = draw.integers(1, 300, 40)
    text = np.concatenate([np.tile(draw.integers(256 - letters, 256, 150).astype(np.uint8), 3)[:c + 99] for c in count])
    first = np.cumsum(count + 99) - (count + 99)
    windows = [text[f + k:f + k + 100].tobytes() for f, c in zip(first, count) for k in range(c)]
    ranks = {w: i for i, w in enumerate(sorted(set(windows)))}
    assert suffix_dedup.suffix_buckets(text, first, count, 100).tolist() == [ranks[w] for w in windows]


def test_values_too_large_to_be_packed_sort_alike():
    values = np.random.default_rng(2).integers(0, 50, 1000)
    for limit in (50, 1 << 60):
        order, found = suffix_dedup._in_order(values, limit)
        assert found.tolist() == sorted(values.tolist()) == values[order].tolist()
        assert sorted(order.tolist()) == list(range(1000))


def test_blocks_fit_a_cache(monkeypatch):
    """Sorting blocks of 1 MB cost three times the time; a gram is whole in one block."""
    sizes, grams = [], []
    block = suffix_dedup._block

    def noted(rows, width):
        sizes.append(sum(map(len, rows["body"].to_pylist())))
        grams.append(set(rows["gram"].to_pylist()))
        return block(rows, width)

    monkeypatch.setattr(suffix_dedup, "_block", noted)
    n = 10_000
    rows = pa.record_batch({
        "kind": pa.array([0] * n, pa.int32()), "gram": pa.array([i // 3 for i in range(n)], pa.int64()), "salt": pa.array([0] * n, pa.int32()),
        "salts": pa.array([1] * n, pa.int32()), "doc_id": pa.array(range(n), pa.int64()), "text_key": pa.array(range(n), pa.int32()),
        "start": pa.array([0] * n, pa.int64()), "windows": pa.array([1] * n, pa.int32()),
        "body": pa.array([f"{i // 2:0100d}".encode() for i in range(n)], pa.binary())})
    list(suffix_dedup._refine(100)(iter(rows.slice(i, 1000) for i in range(0, n, 1000))))
    assert max(sizes) <= 1 << 18
    assert sum(sizes) == 100 * n and sum(map(len, grams)) == len(set().union(*grams))


def test_repeats_of_nothing(empty):
    assert suffix_dedup.repeats_removed(empty).count() == 0


def shingles(text, words):
    tokens = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not tokens:
        return frozenset()
    return frozenset(tuple(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1)))


def brute_components(rows, words, percent):
    sets = [shingles(t, words) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d if d is not None else -1), len(sets[i]), least.get(find(i), -1)) for i, (d, _) in enumerate(rows))


def found_components(df, **options):
    rows = chosen_path.near_duplicates(df, **options).collect()
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_shingles"],
                   r["component_id"] if r["component_id"] is not None else -1) for r in rows)


def test_near_duplicates_of_odd_rows(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found_components(docs) == brute_components(rows, 5, 80)


@pytest.mark.parametrize(("leaf", "block"), [(256, 2048), (3, 4)])
def test_near_duplicates_of_drawn_rows(spark, docs, monkeypatch, leaf, block):
    """Groups around the threshold and a passage that all share; low limits give deep trees and pairs of blocks."""
    monkeypatch.setattr(chosen_path, "LEAF", leaf)
    monkeypatch.setattr(chosen_path, "BLOCK", block)
    draw = random.Random(leaf)
    shared = " ".join(f"s{i}" for i in range(30))
    bases = [[f"b{k}_{i}" for i in range(draw.randint(30, 120))] for k in range(5)]
    rows = []
    for i in range(90):
        words = list(draw.choice(bases))
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(len(words))] = f"edit{i}{draw.randint(0, 2)}"
        rows.append((i, " ".join(words) + (" " + shared if draw.random() < 0.8 else "")))
    rows += [(90, "one two"), (91, "One  two"), (92, "one two three")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found_components(df, words=4) == brute_components(rows, 4, 80)


@pytest.mark.parametrize("count", [1, 2, 3, 4])
def test_near_duplicates_of_one_short_row(spark, docs, count):
    """Fewer words than a shingle in all of a batch."""
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(count)))], "doc_id long, text string").coalesce(1)
    assert found_components(df) == [(1, 1, 1)]


def test_near_duplicates_of_a_short_row_between_long_ones(spark, docs):
    """A slice of its own, as its neighbours fill one each; its copy lies in another partition."""
    long = [" ".join(f"{name}{i}" for i in range(70_000)) for name in ("left", "right")]
    assert min(map(len, long)) > 1 << 19
    rows = [(1, long[0]), (2, "one two three"), (3, long[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).unionByName(
        spark.createDataFrame([(4, "One two  three"), (5, "one two")], "doc_id long, text string").coalesce(1))
    assert found_components(df) == brute_components([*rows, (4, "One two  three"), (5, "one two")], 5, 80)


def test_near_duplicates_of_nothing(empty):
    assert chosen_path.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 95, 100])
def test_pairs_at_the_threshold_share_enough_tokens(percent):
    """By the binomial law the token limit loses less than a pair in a million, and pairs at the limit are compared."""
    least, n = chosen_path.least_tokens(percent), chosen_path.TOKENS
    lost = sum(math.comb(n, k) * (percent / 100)**k * (1 - percent / 100)**(n - k) for k in range(least))
    assert 0 < least <= n and lost < 1e-6
    tokens = np.zeros((2, n), np.int32)
    tokens[1, least:] = 1
    assert chosen_path._chain(tokens, np.array([100, 100]), percent) == [(0, 1)]


def test_a_pair_of_few_equal_tokens_is_linked(monkeypatch):
    """33 of 64 tokens, sets of similarity 0.8."""
    monkeypatch.setattr(chosen_path, "minwise", lambda s: np.arange(64) + (64 if s[0] == 1 else 0) * (np.arange(64) >= 33))
    sets = [np.arange(0, 9, dtype=np.uint64), np.arange(1, 10, dtype=np.uint64)]
    assert chosen_path._confirmed(sets, 80) == [(0, 1)]


def test_components_of_chains_and_stars(spark, docs):
    edges = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)] + [("s9", f"s{i}") for i in range(9)] + [("x", "x")]
    labels = components(spark.createDataFrame(edges, "u string, v string")).collect()
    assert len({r["label"] for r in labels}) == 2 and len(labels) == 71


def brute_contamination(rows, items, window):
    tokens = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for doc_id, text in rows:
        words, hit, found = tokens(text), set(), set()
        for item_id, item in items:
            own = tokens(item)
            for k in range(max(1, len(own) - window + 1) if own else 0):
                part = own[k:k + window]
                for at in range(len(words) - len(part) + 1):
                    if words[at:at + len(part)] == part:
                        hit.update(range(at, at + len(part)))
                        found.add(item_id)
        out.append((doc_id if doc_id is not None else -1, len(words), sorted(hit), sorted(found)))
    return sorted(out)


@pytest.mark.parametrize("block_words", [200_000, 25])
def test_contamination(spark, docs, block_words):
    """In one block or several; items of few words, without words, repeated, and NULL."""
    texts = [r["text"] for r in docs.collect() if r["text"] and len(r["text"]) > 500]
    words = texts[0].split()
    items = [(1, " ".join(words[3:16])), (2, "QUICK, brown! fox"), (3, None), (4, "?!"), (5, "quick brown fox"), (6, "日本語"),
             (7, " ".join(words[8:17])), (7, " ".join(words[10:30])), (8, "never seen words in any of these documents at all here")]
    rows = [(r["doc_id"], (r["text"] or "")[:3000]) for r in docs.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(df, benchmark, block_words=block_words)
    found = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"],
                    [w for a, b in zip(r["hits"][::2], r["hits"][1::2]) for w in range(a, b)], sorted(r["items"]))
                   for r in got.collect())
    assert found == brute_contamination(rows, items, 10)
    text_of = {(r["doc_id"]): r["text"] for r in df.collect()}
    for r in decontaminate.spans(got).collect():
        for a, b in zip(r["spans"][::2], r["spans"][1::2]):
            assert text_of[r["doc_id"]][a:b].strip() == text_of[r["doc_id"]][a:b] != ""


def test_contamination_of_nothing(spark, docs, empty):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(empty, benchmark).count() == 0
    assert decontaminate.contamination(docs, benchmark).where("size(items) > 0").count() == 0


def test_digest_of_kept_bytes_is_of_the_text(docs):
    rows = {r["doc_id"]: r for r in suffix_dedup.repeats_removed(docs).collect()}
    assert hashlib.sha256(bytes(rows[13]["kept"])).hexdigest() == hashlib.sha256(b"x").hexdigest()


@pytest.mark.parametrize("text", [b"a" * 5000, b"ab" * 3000, b"abc" * 500 + b"x" * 4000 + b"abc" * 500, bytes(range(256)) * 20])
def test_texts_of_few_letters_have_few_runs(text):
    """Runs cover each window once, in order, and none is longer than its place can tell."""
    data = np.frombuffer(text, np.uint8)
    row, start, count, _, twice = suffix_dedup.runs(data, np.array([0, len(text)]), 100)
    assert (row == 0).all() and start[0] == 0 and (start[1:] == start[:-1] + count[:-1]).all()
    assert start[-1] + count[-1] == len(text) - 99 and count.max() <= suffix_dedup.RUN_WINDOWS
    if len(set(text)) < 3:
        assert len(start) < len(text) // 40 and twice[0]


def test_columns_with_odd_names(spark):
    """Names with dots and backticks, through an operator that carries columns along and through the pipeline's stages."""
    import corpus_pipeline

    text = "The same long sentence stands here twice and is longer than a hundred bytes, so that it is found and cut out of one."
    rows = spark.createDataFrame([(1, text + " One.", "en"), (2, "Two. " + text, "en"), (3, "short words only", "en")], "doc_id long, text string, lang string")
    table = rows.selectExpr("*", "'d' AS `a.b`", "'t' AS `a``b`", "struct(1 AS x) AS `own_ids`", "length(text) AS n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, "/root/testdata/sf0.001")
        assert out.columns == table.columns, name
        assert {r["a.b"] for r in out.collect()} == {"d"}
    with pytest.raises(ValueError):
        suffix_dedup.repeats_removed(rows, width=suffix_dedup.MAX_WIDTH + 1)
