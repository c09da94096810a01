"""Whole results against plain versions: sharding, language identification, and the pipeline from documents to sequences."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roompulse.llm import bytetext, language_id, registry
from roompulse.llm.encoding import tokenizer_path
from test_dedup import brute_components, brute_contamination, brute_removed

SMALL = "/root/testdata/sf0.001"


def test_shards_of_all_documents(spark):
    """The query's digests, its law, and balance: no shard is fuller than an even share by more than the largest group."""
    rows = registry.QUERIES["op5_best_fit_sharding"](spark, SMALL).collect()
    texts = Counter((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts.elements())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)} and {r["shard"] for r in rows} <= set(range(8))
    homes, loads, slots, groups = defaultdict(set), Counter(), defaultdict(list), Counter()
    text_of = {i: t or "" for i, t in texts}
    for r in rows:
        homes[text_of[r["doc_id"]]].add(r["shard"])
        groups[text_of[r["doc_id"]]] += r["size"]
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    even, largest = sum(loads.values()) / 8, max(groups.values())
    assert max(loads.values()) <= max(even * 1.01, largest) and min(loads[k] for k in range(8)) >= even * 0.9 - largest


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_are_as_even_as_the_groups_allow(spark, shards):
    from roompulse.llm import sharding

    draw = np.random.default_rng(2)
    rows = [(i, "x" * int(draw.integers(0, 400))) for i in range(600)] + [(900 + i, "same " * 30) for i in range(40)] + [(None, None), (None, "")]
    found = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), shards=shards).collect()
    loads = Counter()
    for r in found:
        loads[r["shard"]] += r["size"]
    largest = max(sum(len(t or "") + 1 for _, t in rows if (t or "") == g) for g in {t or "" for _, t in rows})
    assert len(found) == len(rows) and max(loads.values()) - min(loads.values()) <= largest


def plain_language(text, weights):
    """Mean probabilities over the positions of a text: both recurrences byte by byte, anew for each segment."""
    data = text.encode()
    logistic = lambda v: 1 / (1 + np.exp(-v))

    def states(part, side):
        w, u = weights["w" + side].astype(float), weights["u" + side].astype(float)
        h, out = u.shape[1], []
        state = np.zeros(h)
        for byte in part if side == "f" else part[::-1]:
            inner = u @ state
            z, r = (logistic(w[k * h:(k + 1) * h, byte] + inner[k * h:(k + 1) * h]) for k in (0, 1))
            n = np.tanh(w[2 * h:, byte] + r * inner[2 * h:])
            state = (1 - z) * n + z * state
            out.append(state)
        return out if side == "f" else out[::-1]

    total = np.zeros(len(weights["bias"]))
    for at in range(0, len(data), language_id.SEGMENT):
        part = data[at:at + language_id.SEGMENT]
        for ahead, back in zip(states(part, "f"), states(part, "b")):
            scores = weights["of"].astype(float) @ ahead + weights["ob"].astype(float) @ back + weights["bias"][:, 0]
            scores = np.exp(scores - scores.max())
            total += scores / scores.sum()
    return total / max(1, len(data))


def test_languages_of_whole_documents_against_a_plain_loop(spark):
    rows = [(r["doc_id"], (r["text"] or "")[:3000]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    rows += [(900, "é"), (901, "a" * 64), (902, "b" * 65), (903, "123 !"), (904, "")]
    weights = language_id.new_weights(4, seed=5)
    docs = spark.createDataFrame(rows + [(905, None)], "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in language_id.predicted(docs, list("wxyz"), weights).collect()}
    for doc_id, text in rows:
        r = found[doc_id]
        if not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        probs = plain_language(text, weights)
        assert r["score"] == pytest.approx(probs.max(), abs=1e-4)
        assert probs["wxyz".index(r["lang_pred"])] == pytest.approx(probs.max(), abs=1e-4)
    assert found[905]["lang_pred"] == "und"


def test_documents_without_ids_are_drawn_for_training(spark):
    rows = [(None, f"text number {i} of one language", "en") for i in range(300)] + [(None, f"ein Satz {i} auf deutsch", "de") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    if docs.select(language_id.held_out(F.col("doc_id"))).first()[0]:
        docs = docs.withColumn("doc_id", F.lit(1).cast("long"))
    languages, weights = language_id.fit(docs, train_docs=20)
    assert languages == ["de", "en"] and weights


def test_the_pipeline_against_plain_versions(spark):
    """Each stage on its own input, and ``run`` as their composition."""
    import corpus_pipeline

    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]

    kept = stages[0](spark, table, SMALL).cache()
    letters = [r for r in rows(table) if r[1] and any(c.isalpha() for c in r[1])]
    assert sorted(rows(kept)) == sorted(letters)
    languages, weights = language_id.fit(table)
    lang = {r["doc_id"]: r["lang"] for r in kept.collect()}
    for doc_id, text in letters[:40]:
        data, offsets = bytetext.utf8(pa.array([text]))
        probs = np.sort(language_id.pooled(data, offsets, weights)[0])
        if probs[-1] - probs[-2] > 1e-3:
            assert lang[doc_id] == languages[int(plain_language(text[:0] or text, weights).argmax())]

    unique = stages[1](spark, kept, SMALL).cache()
    first = {c for _, _, c in brute_components(rows(kept), 5, 80) if c is not None}
    wordless = {i for i, t in rows(kept) if not t.split()}
    assert sorted(rows(unique)) == sorted(r for r in rows(kept) if r[0] in first | wordless)

    cut = stages[2](spark, unique, SMALL).cache()
    left = [(i, kept_bytes.decode("utf-8", "ignore"), n) for i, n, _, kept_bytes in brute_removed(rows(unique), 100)]
    assert sorted(rows(cut)) == sorted((i, t) for i, t, n in left if t or not n)
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = stages[3](spark, cut, SMALL).cache()
    found = contaminated(rows(cut), items)
    assert sorted(rows(clean)) == sorted(r for r in rows(cut) if r[0] not in found) and found

    encode = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")).encode
    whole = {i: [*encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows(clean)}
    packed = corpus_pipeline.run(spark, SMALL).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packed:
        ids = whole[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes()) and r["doc_tokens"] == len(whole[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == whole.keys()
    for doc_id, parts in pieces.items():
        parts.sort()
        assert [s for s, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) == len(whole[doc_id])
    for parts in sequences.values():
        parts.sort()
        assert [s for s, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= 2048


def contaminated(rows, items):
    """Ids of the documents in which an item's window occurs."""
    return {r[0] for r in brute_contamination(rows, items, 10) if r[2]}
