"""Benchmark decontamination with an Aho-Corasick automaton over words.

Items and documents are normalised alike: A to Z in lower case, words of digits, letters and all characters
beyond ASCII. Each distinct word of the items gets a code point of its own and any other word code point 0, so
a text becomes a string with one character per word and an item window a pattern of ten characters. The automaton
scans that string once; word positions map back to the original text through the word borders.

The items of one automaton are bounded by ``BLOCK_WORDS``: where a benchmark is larger, its items are dealt to
blocks by hash, and the documents are scanned once per block, each pass adding its hits to those before.

NULL and empty texts have no words and no hits. Items without words are never found; repeated items and items
with equal text are found together. Rows stay as they are: one result row per document row, equal ids included.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm import bytetext
from roompulse.llm.storage import documents, mapped, own_columns, saved

WINDOW = 10
BLOCK_WORDS = 200_000
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _codes(ranks: np.ndarray) -> np.ndarray:
    """Code points from 1, past the surrogates."""
    if len(ranks) and int(ranks.max()) + 1 + 0x800 > 0x10FFFF:
        raise ValueError("a block of items has more distinct words than there are code points; one item isn't divided")
    codes = (ranks + 1).astype(np.uint32)
    codes[codes >= 0xD800] += 0x800
    return codes


class Scanner:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        data, offsets = bytetext.utf8(pa.array([text for _, text in items], pa.string()))
        data = bytetext.lower(data)
        starts, ends, rows = bytetext.words(data, offsets, LETTERS)
        hashes = bytetext.span_hashes(data, starts, ends)
        self.vocabulary = np.unique(hashes)
        text = _codes(np.searchsorted(self.vocabulary, hashes)).astype("<u4").tobytes().decode("utf-32-le")
        found: dict[str, set[int]] = {}
        for i in range(len(items)):
            own = text[rows[i]:rows[i + 1]]
            for k in range(max(1, len(own) - window + 1) if own else 0):
                found.setdefault(own[k:k + window], set()).add(i)
        self.ids = [item_id for item_id, _ in items]
        self.automaton = ahocorasick.Automaton()
        for pattern, owners in found.items():
            self.automaton.add_word(pattern, (len(pattern), tuple(owners)))
        self.empty = not found
        if found:
            self.automaton.make_automaton()

    def text(self, hashes: np.ndarray) -> str:
        codes = np.zeros(len(hashes), np.uint32)
        if len(self.vocabulary):
            place = np.searchsorted(self.vocabulary, hashes)
            place[place == len(self.vocabulary)] = 0
            known = self.vocabulary[place] == hashes
            codes[known] = _codes(place[known])
        return codes.astype("<u4").tobytes().decode("utf-32-le")

    def scan(self, text: str) -> tuple[list[tuple[int, int]], set[int]]:
        """Runs of hit words (first, end) and the items whose windows occur."""
        runs: list[list[int]] = []
        owners: set[int] = set()
        for end, (length, who) in self.automaton.iter(text):
            first = end + 1 - length
            while runs and runs[-1][1] >= first:
                first = min(first, runs.pop()[0])
            runs.append([first, end + 1])
            owners.update(who)
        return [(a, b) for a, b in runs], owners


_SCANNERS: dict[str, Scanner] = {}


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _pass(docs: DataFrame, items: list[tuple[int | None, str | None]], window: int) -> DataFrame:
    key = uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _SCANNERS:
            _SCANNERS.clear()
            _SCANNERS[key] = Scanner(items, window)
        scanner = _SCANNERS[key]
        for batch in batches:
            data, offsets = bytetext.utf8(batch["text"])
            counts, hits, found = [], batch["hits"].to_pylist(), batch["items"].to_pylist()
            for first, last in bytetext.slices(offsets):
                part = bytetext.lower(data[offsets[first]:offsets[last]])
                starts, ends, rows = bytetext.words(part, offsets[first:last + 1] - offsets[first], LETTERS)
                text = scanner.text(bytetext.span_hashes(part, starts, ends))
                counts.append(np.diff(rows))
                for i in range(last - first if not scanner.empty else 0):
                    runs, owners = scanner.scan(text[rows[i]:rows[i + 1]])
                    if owners:
                        before = hits[first + i]
                        runs += list(zip(before[::2], before[1::2], strict=True))
                        hits[first + i] = [x for run in _merged(runs) for x in run]
                        found[first + i] = list({*found[first + i], *(scanner.ids[k] for k in owners)})
            own = [c for c in batch.schema.names if c.startswith("own_")]
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], batch["text"], pa.array(np.concatenate([np.zeros(0, np.int64), *counts]), pa.int64()),
                pa.array(hits, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.int64())), *(batch[c] for c in own),
            ], names=["doc_id", "text", "n_words", "hits", "items", *own])

    return docs.transform(mapped, scan, f"doc_id {dict(docs.dtypes)['doc_id']}, text string, n_words long, hits array<int>, items array<long>"
                           + own_columns(docs))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                  id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: its text, number of words, hit words as flat (first, end) runs, and items found.

    Columns named in ``carry`` go along, with ``own_`` before their names.
    """
    items = benchmark.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    size = F.size(F.split(F.col("text"), "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+"))
    total = items.agg(F.sum(F.greatest(size, F.lit(1)))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    out = documents(docs, id_col, text_col, carry).select(
        "*", F.array().cast("array<int>").alias("hits"), F.array().cast("array<long>").alias("items"))
    for block in range(blocks):
        rows = [(r["item_id"], r["text"]) for r in dealt.where(F.col("block") == block).collect()]
        if block:
            out = saved(out.drop("n_words"), "scanned")
        out = _pass(out, rows, window)
    return out


def spans(docs: DataFrame) -> DataFrame:
    """The hit runs of ``contamination`` as character spans (first, end) of the original text."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, hits in zip(batch["text"].to_pylist(), batch["hits"].to_pylist(), strict=True):
                if not hits:
                    out.append([])
                    continue
                data, offsets = bytetext.utf8(pa.array([text]))
                starts, ends, _ = bytetext.words(bytetext.lower(data), offsets, LETTERS)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                out.append([int(chars[starts[a]] if k == 0 else chars[ends[a - 1]])
                            for run in zip(hits[::2], hits[1::2], strict=True) for k, a in enumerate(run)])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.list_(pa.int64()))], names=["doc_id", "spans"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text", "hits").transform(mapped, locate, f"doc_id {kind}, spans array<long>")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan all documents for the windows of all benchmark items."""
    from roompulse.llm.storage import table

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    odd = F.expr("filter(hits, (x, i) -> i % 2 = 1)")
    even = F.expr("filter(hits, (x, i) -> i % 2 = 0)")
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    ids = F.array_sort(F.transform("items", lambda x: F.coalesce(x.cast("string"), F.lit(""))))
    return saved(found.select(
        "doc_id", "n_words", (total(odd) - total(even)).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    ), "contamination")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
         list_aggregate(w[k:k + 9], 'string_agg', ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, k, list_aggregate(w[k:k + size - 1], 'string_agg', ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size)
), found AS (
  SELECT doc_id, k, i.size, item_id FROM doc_windows w JOIN item_windows i ON w.win = i.win AND w.size = i.size
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM (SELECT DISTINCT doc_id, k, size FROM found)) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
