"""Conversation prefix trie: the hash, and whole results against a plain version."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from roompulse.llm import prefix_trie

WORDS = re.compile("[^\\x20\\x09-\\x0D]+")


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000])
def test_slot_table_is_minimal_and_verified(n):
    draw = np.random.default_rng(n)
    d1, d2 = (draw.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(2))
    d1[:n // 2] = 7  # halves alone don't tell keys apart
    table = prefix_trie.SlotTable(d1, d2)
    assert sorted(table.slots) == list(range(n))
    assert (table.find(d1, d2) == table.slots).all()
    other = table.find(d1, d2 + np.uint64(1))
    assert (other == -1).all()


def test_slot_table_with_one_digest_twice():
    with pytest.raises(ValueError):
        prefix_trie.SlotTable(np.array([5, 5], np.uint64), np.array([6, 6], np.uint64))


def original(rows):
    """Turns (role, text) of each conversation in order."""
    name = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            found[conv].append((turn is not None, turn or 0, name(role, text), role, text))
    return {conv: [t[3:] for t in sorted(turns)] for conv, turns in found.items()}


def rebuilt(own):
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (conv % 20 if conv >= 0 else -(-conv % 20))
        out[conv] = own.get(base, [])[:h] + turns[h:]
    return out


def plain_trie(conversations):
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in conversations.items():
        ends[tuple(turns)].append(conv)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    out = []
    for path, some in members.items():
        under = [p for p in members if p[:len(path)] == path]
        children = [p for p in under if len(p) == len(path) + 1]
        leaves = [p for p in under if not any(q[:-1] == p and q for q in members)]
        saved = sum((len(members[p]) - 1) * (len(WORDS.findall(p[-1][1])) if p else 0) for p in under)
        out.append((min(some), len(path), min(members[path[:-1]]) if path else None, len(some), len(children), len(leaves), saved,
                    hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: r[:2])


def odd_rows():
    draw = np.random.default_rng(11)
    rows = []
    for conv in [*range(0, 70), -1, -7, -20, -21, 1003, 10**15]:
        for turn in range(int(draw.integers(1, 6))):
            rows.append((conv, turn, ["user", "assistant"][turn % 2], f"t{draw.integers(0, 3)} word " * int(draw.integers(0, 3))))
    rows += [(200 + i, t, "user", f"same {t}") for i in range(30) for t in range(3)]  # copies
    rows += [(400, t, "user", f"long {t % 2}") for t in range(300)]  # a conversation with a third of the rows
    rows += [(3, None, "system", "first"), (3, None, None, None), (5, 0, "user", None), (5, 0, "user", None), (5, 0, None, "  é x")]
    rows += [(None, 0, "user", "of no conversation"), (None, None, None, None), (7, 2, "ab", "c"), (7, 2, "a", "bc"), (8, 1, "", "x" * 200_000)]
    return rows


@pytest.mark.parametrize("shard", [3, 1 << 15])
def test_trie_against_a_plain_version(spark, monkeypatch, shard):
    """Also with shards so small that paths cross many of them."""
    monkeypatch.setattr(prefix_trie, "SHARD", shard)
    rows = odd_rows()
    if shard == 3:
        rows = [r for r in rows if r[0] != 400 or r[1] < 40]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6).selectExpr(
        "*", "1 AS part", "2 AS depth", "3 AS shard", "'k' AS key", "4 AS d1", "5 AS `a.b`", "6 AS words")
    folder = prefix_trie.new_folder(spark, "test-trie")
    turns = prefix_trie.placed_turns(table, f"{folder}/turns")
    trie = prefix_trie.prefix_trie(*prefix_trie.rebuilt_turns(turns, f"{folder}/shaped"))
    assert found(trie) == plain_trie(rebuilt(original(rows)))


def test_trie_of_conversations_as_they_are(spark):
    rows = odd_rows()[:120]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = prefix_trie.placed_turns(table, prefix_trie.new_folder(spark, "test-trie"))
    assert found(prefix_trie.prefix_trie(*prefix_trie.own_turns(turns))) == plain_trie(original(rows))


def test_trie_of_nothing(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    folder = prefix_trie.new_folder(spark, "test-trie")
    turns = prefix_trie.placed_turns(table, f"{folder}/turns")
    assert prefix_trie.prefix_trie(*prefix_trie.rebuilt_turns(turns, f"{folder}/shaped")).count() == 0


def test_digests_of_many_members_come_from_pieces(spark, monkeypatch):
    monkeypatch.setattr("roompulse.llm.storage.BATCH_ROWS", 10)
    ends = spark.range(-500, 4000).selectExpr("1L AS depth", "2L AS d1", "CAST(id % 2 AS LONG) AS d2", "id AS conv_id").repartition(7)
    for row in prefix_trie.ends_digests(ends).collect():
        ids = sorted(i for i in range(-500, 4000) if int(np.fmod(i, 2)) == row["d2"])
        assert row["ends_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
