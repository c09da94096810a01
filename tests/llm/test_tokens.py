"""Encoding, token files and packing against the tokenizers library called on whole texts."""

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from roompulse.llm import bytetext, packing
from roompulse.llm.encoding import PieceEncoder, encoding_task, tokenizer_path
from roompulse.llm.token_files import read_token_files, write_token_files
from roompulse.workspace import new_folder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ALPHABET = ["a", "B", "é", " ", "  ", "\n", "\t", "'", "'s", ",", ".", "(", "1", "\x1c", "\x00", "¤", "<|endoftext|>", "\u0301",
            "İ", "Σ", "…", "“", "日本", "\r\n", "\u0085", "\u3000", "_", "ﬁ", "🙂"]


def whole(name):
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
def test_pieces_give_the_ids_of_whole_texts(name):
    draw = random.Random(3)
    texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 12))) for _ in range(4000)] + [None, ""]
    encoder, reference = PieceEncoder(tokenizer_path(name)), whole(name)
    for part in (texts[:2500], texts[2500:]):
        data, offsets = bytetext.utf8(pa.array(part))
        ids, counts = encoder.encode(data, offsets)
        ends = np.cumsum(counts)
        for text, end, count in zip(part, ends, counts, strict=True):
            assert ids[end - count:end].tolist() == reference(text), repr(text)


def by_default(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


ADDED = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "<|", "|>", "endoftext", "İ<|endoftext|>"]


def drawn_with_added(count, seed):
    draw = random.Random(seed)
    texts = ["".join(draw.choice(ALPHABET + ADDED) for _ in range(draw.randint(0, 12))) for _ in range(count)]
    return [*texts, None, "", "<|endof", "text|>", "<|endoftext|>", "<|endoftext|>" * 3, "ab <|endoftext|> cd", "\n<|endoftext|>\n"]


@pytest.mark.parametrize("odd", [None, {"lstrip": True}, {"special": False, "normalized": True}])
@pytest.mark.parametrize("name", FILES)
def test_literal_added_tokens_get_the_ids_of_the_library(name, odd, tmp_path):
    """By the defaults of the library, also for added tokens that take white space or are looked for in normalized text."""
    path = tokenizer_path(name)
    if odd:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        content["added_tokens"][0].update(odd)
        path = str(tmp_path / name)
        with open(path, "w", encoding="utf-8") as file:
            json.dump(content, file)
    texts, reference = drawn_with_added(400 if odd else 4000, 5), by_default(path)
    with encoding_task(path) as encoder:
        for part in (texts[:300], texts[300:]):
            ids, counts = encoder.encode(*bytetext.utf8(pa.array(part)))
            for text, end, count in zip(part, np.cumsum(counts), counts, strict=True):
                assert ids[end - count:end].tolist() == reference(text), repr(text)


def test_literal_added_tokens_in_files_and_sequences(spark, docs):
    """Ids, starts of later documents and counts are those of the library's defaults."""
    rows = list(enumerate(drawn_with_added(60, 6)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = tokenizer_path(FILES[0])
    reference, at = by_default(path), 0
    found = read_token_files(write_token_files(df, path, new_folder(spark, "tokens"), end_id=0)).collect()
    for (doc_id, text), r in zip(rows, sorted(found, key=lambda r: r["doc_id"]), strict=True):
        ids = [*reference(text), 0]
        assert (r["doc_id"], r["start"], bytes(r["ids"])) == (doc_id, at, np.array(ids, "<u4").tobytes())
        at += len(ids)
    path = tokenizer_path(FILES[1])
    reference, by_doc = by_default(path), defaultdict(list)
    for r in packing.packed(df, path, end_id=1).collect():
        by_doc[r["doc_id"]].append((r["start"], r["doc_tokens"], bytes(r["ids"])))
    for doc_id, text in rows:
        ids = [*reference(text), 1]
        assert all(n == len(ids) for _, n, _ in by_doc[doc_id])
        assert b"".join(b for *_, b in sorted(by_doc[doc_id])) == np.array(ids, "<u4").tobytes()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, docs):
    path = tokenizer_path(FILES[0])
    rows = read_token_files(write_token_files(docs, path, new_folder(spark, "tokens"), end_id=0)).collect()
    reference = whole(FILES[0])
    expected = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])] == [d for d, _ in expected]
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, bytes(r["ids"])) for r in rows)
    assert got == sorted((d if d is not None else -1, np.array([*reference(t), 0], "<u4").tobytes()) for d, t in expected)
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += len(r["ids"]) // 4


def test_files_of_other_stores_are_read_by_range(tmp_path):
    """Slices are those of the whole file, and no read asks for more than its slice."""
    from pyarrow import fs

    from roompulse.llm import token_files

    values = np.arange(5000, dtype="<u2")
    values.tofile(tmp_path / "x.ids")
    store = fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())
    with token_files._ranges(store, "x.ids", "<u2") as ids:
        opened, asked = ids.file, []

        class Counted:
            seek, close = opened.seek, opened.close

            def read(self, size):
                asked.append(size)
                return opened.read(size)

        ids.file = Counted()
        for a, b in ((0, 10), (4000, 5000), (7, 7), (20, 1000)):
            assert ids[a:b].tolist() == values[a:b].tolist()
        assert asked == [20, 2000, 0, 1960]
        with pytest.raises(EOFError):
            ids[4990:5001]
    with token_files._ranges(fs.LocalFileSystem(), str(tmp_path / "x.ids"), "<u2") as ids:
        assert isinstance(ids.local, np.memmap) and ids[20:30].tolist() == values[20:30].tolist()


def test_token_files_of_nothing(spark, empty):
    assert read_token_files(write_token_files(empty, tokenizer_path(FILES[0]), new_folder(spark, "tokens"), 0)).count() == 0


@pytest.mark.parametrize("length", [1, 2, 31, 1023, 1024, 1025, 1500, 2047, 2048, 2049, 70_001])
def test_cuts_cover_a_document(length):
    parts = packing.cuts(length, 2048)
    assert sum(parts) == length and all(0 < p <= 2048 for p in parts)
    assert len(parts) <= length // 2048 + 5


def test_packing_places_every_id_once(spark, docs):
    rows = packing.packed(docs, tokenizer_path(FILES[1]), end_id=1).collect()
    reference = whole(FILES[1])
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"]
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(bins) == list(range(len(bins)))
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[(r["doc_id"], r["doc_tokens"])].append((r["start"], bytes(r["ids"])))
    for doc_id, text in {(r["doc_id"], r["text"]) for r in docs.collect()}:
        ids = np.array([*reference(text), 1], "<u4").tobytes()
        found = sorted(set(by_doc[(doc_id, len(ids) // 4)]))
        assert b"".join(b for _, b in found) == ids
    used = sum(r["length"] for r in rows)
    assert used / (2048 * len(bins)) > 0.9


def test_packing_nothing(spark, empty):
    assert packing.packed(empty, tokenizer_path(FILES[1]), end_id=1).count() == 0


@pytest.mark.parametrize("limit", [1, 20, 300])
def test_forgotten_pieces_are_encoded_again(monkeypatch, limit):
    """A table so small that pieces go after nearly every slice, added tokens excepted."""
    monkeypatch.setattr("roompulse.llm.encoding.CACHE_PIECES", limit)
    draw = random.Random(9)
    words = [f"w{i}" * (1 + i % 3) for i in range(200)] + ["<|endoftext|>"]
    path = tokenizer_path(FILES[0])
    encoder, reference = PieceEncoder(path, added_tokens=True), by_default(path)
    for _ in range(30):
        texts = [" ".join(draw.choices(words, k=20)) for _ in range(5)]
        ids, counts = encoder.encode(*bytetext.utf8(pa.array(texts)))
        ends = np.cumsum(counts)
        assert [ids[e - c:e].tolist() for e, c in zip(ends, counts)] == [reference(t) for t in texts]
        assert len(encoder.ids) == encoder.count.sum() and (np.diff(encoder.keys.astype(object)) > 0).all()
        assert len(encoder.uses) == len(encoder.keys) == len(encoder.first)


@pytest.mark.parametrize("parts", [1, 2, 7, 50])
def test_files_follow_the_ids_however_dealt(spark, parts):
    """An id with a third of the rows, NULL ids, the greatest and least ids, more partitions than rows."""
    rows = [(i, f"text {i}") for i in range(40)] + [(17, f"copy {i}") for i in range(30)] + [(None, "x")] * 9
    rows += [((1 << 63) - 1 - i, f"far {i}") for i in range(5)] + [(-(1 << 63) + 1 + i, "low") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    path, before = tokenizer_path(FILES[0]), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = read_token_files(write_token_files(docs, path, new_folder(spark, "dealt"), end_id=0)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    reference = by_default(path)
    want = sorted(((-(1 << 63) if i is None else i), [*reference(t), 0]) for i, t in rows)
    got = sorted(((-(1 << 63) if r["doc_id"] is None else r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in found)
    assert got == want
    found.sort(key=lambda r: r["start"])
    ids = [-(1 << 63) if r["doc_id"] is None else r["doc_id"] for r in found]
    assert ids == sorted(ids)
    assert [r["start"] for r in found] == np.cumsum([0, *(len(r["ids"]) // 4 for r in found)])[:-1].tolist()
