"""Conversation prefix trie: node tables in flat arrays, slotted by a minimal perfect hash of prefix digests.

A node is a distinct sequence of first turns. Turns are ordered by one range sort, which cuts long conversations into
parts; a prefix's digest is the sum of the hashes of its (place, turn) pairs, so the parts of a conversation need
only the sums of those before them. Distinct digests are enumerated by an aggregation with partial counts, which
also verifies that all members of a node agree on its last turn and on its parent; if not, the job fails.

Nodes are sorted by (smallest member, depth) and cut into shards of at most ``SHARD`` nodes. In a shard a minimal perfect
hash gives each digest a slot, which is verified against the digest stored there. Counts are scattered into flat
arrays by slot, parents become slots, and values are accumulated from the deepest level up. A parent that isn't in the
shard lies in an earlier one: the shard asks for its place once, and what its nodes add up to is sent there, summed per
slot, round by round until nothing is sent any more. A node of a third of all conversations, or one with a third of all
nodes as children, gets one message per shard. The number of rounds is that of the shards that the longest way up
crosses.

The members that end at a node are sorted over all tasks and joined to pieces of text there; one task then
hashes a node's pieces in order without holding them together, since a SHA-256 can't be put together from parts.

NULL roles and texts are empty; rows without a conversation id belong to none and are left aside; NULL turns come first; rows
of equal turn are ordered by the SHA-256 of their role and text, repeated rows stay; a conversation without turns is a member
of the root; texts are never cut; an empty table gives no nodes. Other columns are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roompulse.llm.bytetext import mix
from roompulse.llm.storage import dropped, finished, mapped, saved
from roompulse.workspace import new_folder

SHARD = 1 << 15
#: Shard rows of an Arrow batch.
BATCH_SHARDS = 4
#: Part number of turns that a conversation takes over from another one.
HEAD_PART = -1
FAMILY = 20
HEADS = 4
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 32) - 1
_NODE = ["depth", "d1", "d2"]
_EMPTY = hashlib.sha256().hexdigest()


def placed_turns(conversations: DataFrame, folder: str) -> DataFrame:
    """Each turn's part of its conversation, its place in that part (from 1), the digest of role and text, and its words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("key"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"), F.monotonically_increasing_id().alias("row"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch["conv_id"].to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            places = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids)))) + 1
            if ids[0] == last:
                places[:starts[1] if len(starts) > 1 else None] += done
            last, done = ids[-1], int(places[-1])
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], pa.array(np.full(len(ids), part), pa.int32()), pa.array(places), batch["key"], batch["words"]],
                names=["conv_id", "part", "place", "key", "words"])

    order = ["conv_id", "turn", "key", "row"]
    parts = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "key", "words")
    return saved(parts.transform(mapped, place, "conv_id long, part int, place long, key binary, words long"), "turns", folder)


def part_sizes(turns: DataFrame) -> DataFrame:
    """One row per part of a conversation: its turns, those of the parts before it, and those of the whole conversation."""
    sizes = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("conv_id")
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sizes.select("conv_id", "part", before.alias("before"), F.sum("n").over(whole).alias("total"))


def own_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of each conversation as they are, and the conversations with their number of turns."""
    sizes = part_sizes(turns)
    rows = turns.join(sizes, ["conv_id", "part"]).withColumn("depth", F.col("before") + F.col("place"))
    members = sizes.where("before = 0").select("conv_id", F.col("total").alias("n_turns"))
    return rows.select("conv_id", "part", "depth", "key", "words", (F.col("depth") == F.col("total")).alias("last")), members


def rebuilt_turns(turns: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of their family's first one.

    Conversation c takes its first h turns, h = crc32(decimal c) % 4, from conversation c - c % 20 (all if it has
    fewer), and goes on with its own turns after its first h.
    """
    sizes = part_sizes(turns)
    first = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS)).join(sizes, ["conv_id", "part"])
    rank = F.col("before") + F.col("place")
    heads = first.where(rank < HEADS).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "key", "words"))).alias("head"))
    drawn = sizes.withColumns({
        "h": F.crc32(F.col("conv_id").cast("string")) % HEADS, "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    taken = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h").cast("int")))
    shaped = drawn.join(heads, "base", "left").select("conv_id", "part", "before", "total", "h", taken.alias("head"))
    shaped = saved(shaped.withColumn("k", F.coalesce(F.size("head"), F.lit(0)).cast("long")), "conversations", folder)
    shaped = shaped.withColumn("k", F.greatest("k", F.lit(0))).withColumn(
        "n_turns", F.col("k") + F.greatest(F.col("total") - F.col("h"), F.lit(0)))
    own = turns.join(shaped.drop("head"), ["conv_id", "part"]).where(rank > F.col("h")).withColumn(
        "depth", F.col("k") + rank - F.col("h"))
    starts = shaped.where("before = 0")
    other = starts.where("k > 0").select("conv_id", "n_turns", F.posexplode("head").alias("at", "turn")).select(
        "conv_id", F.lit(HEAD_PART).alias("part"), (F.col("at") + 1).cast("long").alias("depth"), "turn.key", "turn.words", "n_turns")
    rows = own.select(other.columns).unionByName(other)
    rows = rows.withColumn("last", F.col("depth") == F.col("n_turns")).drop("n_turns")
    return rows, starts.select("conv_id", "n_turns")


def _lanes() -> list[Column]:
    """Four 32-bit hashes of a (place, turn) pair, as longs whose sums can't overflow."""
    out = []
    for seed in (1, 2):
        pair = F.xxhash64(F.lit(seed), "depth", "key")
        out += [F.shiftrightunsigned(pair, 32), pair.bitwiseAND(F.lit(_MASK))]
    return out


def prefixes(turns: DataFrame, members: DataFrame, folder: str) -> DataFrame:
    """One row per conversation and prefix, the empty one included: its digest, its parent's, a check of its last turn."""
    lanes = [f"lane{i}" for i in range(4)]
    rows = turns.withColumns(dict(zip(lanes, _lanes(), strict=True)))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("conv_id", "part").agg(*(F.sum(c).alias(c) for c in lanes)).select(
        "conv_id", "part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in lanes))
    within = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"{c}_here": F.sum(c).over(within) for c in lanes}).join(carried, ["conv_id", "part"])

    def digest(sums: list[Column]) -> list[Column]:
        low = [s.bitwiseAND(F.lit(_MASK)) for s in sums]
        return [F.shiftleft(low[0], 32).bitwiseOR(low[1]), F.shiftleft(low[2], 32).bitwiseOR(low[3])]

    d1, d2 = digest([F.col(f"{c}_here") + F.col(f"{c}_before") for c in lanes])
    p1, p2 = digest([F.col(f"{c}_here") + F.col(f"{c}_before") - F.col(c) for c in lanes])
    rows = rows.select("conv_id", "depth", d1.alias("d1"), d2.alias("d2"), p1.alias("p1"), p2.alias("p2"),
                       F.xxhash64(F.lit(3), "key").alias("check"), "words", "last")
    zero = F.lit(0).cast("long")
    roots = members.select("conv_id", *(zero.alias(c) for c in ("depth", "d1", "d2", "p1", "p2", "check", "words")),
                           (F.col("n_turns") == 0).alias("last"))
    return saved(rows.unionByName(roots), "prefixes", folder)


def distinct_nodes(rows: DataFrame) -> DataFrame:
    """One row per distinct prefix, verified: its smallest member, members, those that end there, its parent's digest, words."""
    same = ("p1", "p2", "check", "words")
    found = rows.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if("last").alias("n_ends"),
        *(F.min(c).alias(c) for c in same), *(F.max(c).alias(f"{c}_max") for c in same))
    agree = F.lit(True)
    for c in same:
        agree = agree & (F.col(c) == F.col(f"{c}_max"))
    stop = F.raise_error(F.lit("two different prefixes have one digest")).cast("long")
    return found.select(*_NODE, "conv_id", "n_convs", F.when(agree, F.col("n_ends")).otherwise(stop).alias("n_ends"), "p1", "p2", "words")


class SlotTable:
    """A minimal perfect hash of distinct 128-bit digests: n keys, slots 0 to n - 1, verified on lookup.

    Keys hash to twice as many places as there are keys; a place with one key is that key's, the others go on to the
    next level. A key's slot is the number of taken places before its own.
    """

    def __init__(self, d1: np.ndarray, d2: np.ndarray):
        self.levels: list[np.ndarray] = []
        slots = np.empty(len(d1), np.int64)
        left, done = np.arange(len(d1)), 0
        while len(left):
            if len(self.levels) > 64:
                raise ValueError("two nodes of a shard have one digest")
            size = 2 * len(left) + 1
            at = self._at(d1[left], d2[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            slot_at = np.where(alone, np.cumsum(alone) - 1 + done, -1)
            self.levels.append(slot_at)
            slots[left] = slot_at[at]
            left, done = left[slot_at[at] < 0], done + int(alone.sum())
        self.slots = slots
        self.d1, self.d2 = np.empty_like(d1), np.empty_like(d2)
        self.d1[slots], self.d2[slots] = d1, d2

    @staticmethod
    def _at(d1: np.ndarray, d2: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * _ODD & (1 << 64) - 1)
        return (mix(d1 + mix(d2 ^ salt)) % np.uint64(size)).astype(np.int64)

    def find(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        """Slots of digests; -1 where the slot holds another one or none."""
        out, left = np.full(len(d1), -1), np.arange(len(d1))
        for level, slot_at in enumerate(self.levels):
            out[left] = slot_at[self._at(d1[left], d2[left], level, len(slot_at))]
            left = left[out[left] < 0]
        known = np.flatnonzero(out >= 0)
        wrong = (self.d1[out[known]] != d1[known]) | (self.d2[out[known]] != d2[known])
        out[known[wrong]] = -1
        return out


#: Flat arrays of a shard, by slot: parent's slot (-1: none here), place in the asked list (-1: none), and the nodes' values.
_ARRAYS = {"parent": "<i4", "asked": "<i4", "depth": "<i8", "d1": "<i8", "d2": "<i8", "conv_id": "<i8",
           "n_convs": "<i8", "n_ends": "<i8", "words": "<i8"}
_SHARD_SCHEMA = "shard long, ask array<struct<depth: long, d1: long, d2: long>>, " + ", ".join(f"{c} binary" for c in _ARRAYS)


def _shard(number: int, table: pa.Table) -> pa.RecordBatch:
    value = {c: table[c].to_numpy() for c in (*_NODE, "conv_id", "n_convs", "n_ends", "p1", "p2", "words")}
    slots = SlotTable(value["d1"].view(np.uint64), value["d2"].view(np.uint64))
    inner = value["depth"] > 0
    parent = np.where(inner, slots.find(value["p1"].view(np.uint64), value["p2"].view(np.uint64)), -1)
    outside = np.flatnonzero(inner & (parent < 0))
    asks, which = np.unique(
        np.stack([value["depth"][outside] - 1, value["p1"][outside], value["p2"][outside]], axis=1), axis=0, return_inverse=True)
    value["parent"], value["asked"] = parent, np.full(len(parent), -1)
    value["asked"][outside] = which.reshape(-1)
    arrays = []
    for name, kind in _ARRAYS.items():
        flat = np.empty(len(parent), kind)
        flat[slots.slots] = value[name]
        arrays.append(pa.array([flat.tobytes()], pa.binary()))
    ask = [{"depth": a, "d1": b, "d2": c} for a, b, c in asks.tolist()]
    kind = pa.list_(pa.struct([("depth", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64())]))
    return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([ask], kind), *arrays], names=["shard", "ask", *_ARRAYS])


def node_shards(nodes: DataFrame, folder: str) -> DataFrame:
    """Nodes in the order of (smallest member, depth), one row of flat arrays per ``SHARD`` of them."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size >= SHARD:
                whole = pa.Table.from_batches(held)
                yield _shard(base, whole.slice(0, SHARD).combine_chunks())
                held, size, base = whole.slice(SHARD).to_batches(), size - SHARD, base + 1
        if size:
            yield _shard(base, pa.Table.from_batches(held).combine_chunks())

    ordered = nodes.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
    return saved(ordered.transform(mapped, build, _SHARD_SCHEMA), "shards", folder)


class Shard:
    """The flat arrays of one shard."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        self.number = batch["shard"][row].as_py()
        for name, kind in _ARRAYS.items():
            setattr(self, name, np.frombuffer(batch[name][row].as_py(), kind))
        links = batch["links"][row].as_py() if "links" in batch.schema.names else None
        asked = int(self.asked.max(initial=-1)) + 1
        self.links = np.zeros((asked, 3), np.int64)  # shard, slot and smallest member of the parents asked for
        for link in links or []:
            self.links[link["at"]] = link["shard"], link["slot"], link["conv_id"]

    def accumulate(self, *values: np.ndarray) -> None:
        """Add each node's values to its parent's, from the deepest level up."""
        order = np.argsort(-self.depth, kind="stable")
        order = order[self.parent[order] >= 0]
        levels = np.flatnonzero(np.diff(self.depth[order], prepend=-1))
        for first, end in zip(levels, [*levels[1:], len(order)], strict=False):
            level = order[first:end]
            for value in values:
                np.add.at(value, self.parent[level], value[level])

    def received(self, batch: pa.RecordBatch, row: int, values: dict[str, np.ndarray]) -> None:
        for message in batch["messages"][row].as_py() or []:
            for name, value in values.items():
                value[message["slot"]] += message[name]

    def sent(self, *values: np.ndarray) -> list[np.ndarray]:
        """The values of nodes with a parent elsewhere, summed per parent."""
        tops = np.flatnonzero(self.asked >= 0)
        out = []
        for value in values:
            total = np.zeros(len(self.links), np.int64)
            np.add.at(total, self.asked[tops], value[tops])
            out.append(total)
        return out

    def start(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Children in this shard, leaves and saved words of the nodes themselves."""
        children = np.bincount(self.parent[self.parent >= 0], minlength=len(self.parent)).astype(np.int64)
        return children, (self.n_convs == self.n_ends).astype(np.int64), (self.n_convs - 1) * self.words


_MESSAGE = "shard long, slot long, children long, leaves long, saved long"


def _messages(first: bool):
    """A task over shards that sends what arrives at nodes whose parent lies elsewhere."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch, row)
                size = len(shard.parent)
                if first:
                    _, leaves, saved_words = shard.start()
                    children = np.ones(size, np.int64)
                else:
                    leaves, saved_words, children = (np.zeros(size, np.int64) for _ in range(3))
                    shard.received(batch, row, {"leaves": leaves, "saved": saved_words})
                shard.accumulate(leaves, saved_words)
                sums = shard.sent(children, leaves, saved_words)
                some = np.flatnonzero(np.any(sums, axis=0)) if len(shard.links) else []
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[some]) for x in (shard.links[:, 0], shard.links[:, 1], *sums)],
                        names=["shard", "slot", "children", "leaves", "saved"])

    return send


def _by_shard(messages: DataFrame) -> DataFrame:
    """Messages summed per slot and listed per shard: at most one for each of its nodes."""
    summed = messages.groupBy("shard", "slot").agg(*(F.sum(c).alias(c) for c in ("children", "leaves", "saved")))
    return summed.groupBy("shard").agg(F.collect_list(F.struct("slot", "children", "leaves", "saved")).alias("messages"))


def _located(shards: DataFrame, folder: str) -> DataFrame:
    """For each shard the places of the parents that it asked for."""

    def where(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch, row)
                size = len(shard.parent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (np.full(size, shard.number), np.arange(size), shard.depth, shard.d1, shard.d2, shard.conv_id)],
                    names=["shard", "slot", *_NODE, "conv_id"])

    places = shards.drop("ask").transform(mapped, where, "shard long, slot long, depth long, d1 long, d2 long, conv_id long")
    asked = shards.select(F.col("shard").alias("from"), F.posexplode("ask").alias("at", "node")).select("from", "at", "node.*")
    found = asked.join(places, _NODE).groupBy(F.col("from").alias("shard")).agg(
        F.collect_list(F.struct("at", "shard", "slot", "conv_id")).alias("links"))
    return saved(found, "links", folder, batch_rows=BATCH_SHARDS)


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The trie of conversations given as turns (conv_id, part, depth, key, words, last) and members (conv_id, n_turns)."""
    spark = turns.sparkSession
    folder = new_folder(spark, "prefix-trie")
    rows = prefixes(turns, members, f"{folder}/prefixes")
    shards = node_shards(distinct_nodes(rows), f"{folder}/shards")
    links = _located(shards, f"{folder}/links")
    linked = shards.drop("ask").join(links, "shard", "left")
    sent, rounds = [], 0
    waiting = linked.where("links is not null").withColumn("messages", F.lit(None).cast(_LISTED))
    while True:
        message = saved(waiting.transform(mapped, _messages(first=rounds == 0), _MESSAGE), "messages",
                        f"{folder}/messages-{rounds}", batch_rows=BATCH_SHARDS)
        if message.isEmpty():
            break
        sent.append(message)
        rounds += 1
        waiting = linked.where("links is not null").join(_by_shard(message), "shard")
    arrived = _by_shard(_all(sent) if sent else message)

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch, row)
                children, leaves, saved_words = shard.start()
                shard.received(batch, row, {"children": children, "leaves": leaves, "saved": saved_words})
                shard.accumulate(leaves, saved_words)
                above = np.where(shard.parent >= 0, shard.conv_id[shard.parent], 0)
                outside = shard.asked >= 0
                above[outside] = shard.links[shard.asked[outside], 2]
                flat = (shard.depth, shard.d1, shard.d2, shard.conv_id, shard.n_convs, children, leaves, saved_words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in flat] + [pa.array(above, mask=shard.depth == 0)],
                    names=[*_NODE, "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "parent_conv_id"])

    schema = ", ".join(f"{c} long" for c in (*_NODE, "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "parent_conv_id"))
    nodes = saved(linked.join(arrived, "shard", "left").transform(mapped, result, schema), "nodes", batch_rows=BATCH_SHARDS)
    ends = ends_digests(rows.where("last").select(*_NODE, "conv_id"))
    finished(spark)
    dropped(spark, folder)
    return nodes.join(ends, _NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))


_LISTED = "array<struct<slot: long, children: long, leaves: long, saved: long>>"


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def ends_digests(ends: DataFrame) -> DataFrame:
    """Per node the SHA-256 of its conversations' decimal ids in ascending order, joined by commas."""

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
        keys = np.stack([batch[c].to_numpy() for c in _NODE], axis=1)
        cuts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else []
        for first, end in zip(cuts, [*cuts[1:], len(keys)], strict=False):
            yield tuple(keys[first].tolist()), first, end

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["conv_id"].to_pylist()
            found = [(*key, ids[first], ",".join(map(str, ids[first:end]))) for key, first, end in runs(batch)]
            yield pa.RecordBatch.from_pylist([dict(zip((*_NODE, "first", "ids"), f, strict=True)) for f in found], schema=pa.schema(
                [(c, pa.int64()) for c in (*_NODE, "first")] + [("ids", pa.string())]))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in _NODE] + [("ends_sha256", pa.string())])
        open_key, digest = None, None
        for batch in batches:
            out, ids = [], batch["ids"].to_pylist()
            for row, key in enumerate(zip(*(batch[c].to_pylist() for c in _NODE), strict=True)):
                if key == open_key:
                    digest.update(b",")
                else:
                    if open_key is not None:
                        out.append((*open_key, digest.hexdigest()))
                    open_key, digest = key, hashlib.sha256()
                digest.update(ids[row].encode())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, o, strict=True)) for o in out], schema=schema)
        if open_key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*open_key, digest.hexdigest()), strict=True))], schema=schema)

    order = [*_NODE, "conv_id"]
    parts = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    joined = saved(parts.transform(mapped, pieces, "depth long, d1 long, d2 long, first long, ids string"), "ends")
    whole = joined.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
    return saved(whole.transform(mapped, digests, "depth long, d1 long, d2 long, ends_sha256 string"), "ends-digests")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt by families."""
    from roompulse.llm.storage import table

    folder = new_folder(spark, "conversations")
    turns = placed_turns(table(spark, sf_dir, "conversations"), f"{folder}/turns")
    rows, members = rebuilt_turns(turns, f"{folder}/shaped")
    out = prefix_trie(saved(rows, "rebuilt", f"{folder}/rebuilt"), members)
    dropped(spark, folder)
    return out


OP11_SQL = r"""
WITH named AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), keyed AS (
  SELECT *, sha256(CAST(octet_length(encode(role)) AS VARCHAR) || ':' || role || text) AS key,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM named
), own AS (
  SELECT conv_id, key, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS r FROM keyed
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, count(*) AS total, xor(4294967295, list_reduce(
    list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
      lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda s, b: CASE WHEN b >= 0 THEN xor(s, b) WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END)) % 4 AS h
  FROM own GROUP BY conv_id
), k AS (
  SELECT c.conv_id, h, c.base, least(h, coalesce(b.total, 0)) AS k, least(h, coalesce(b.total, 0)) + greatest(c.total - h, 0) AS n_turns
  FROM c LEFT JOIN (SELECT conv_id AS base, total FROM c) b ON c.base = b.base
), t AS (
  SELECT k.conv_id, own.r AS depth, key, words FROM k JOIN own ON own.conv_id = k.base AND own.r <= k.k
  UNION ALL SELECT k.conv_id, k.k + own.r - h, key, words FROM k JOIN own ON own.conv_id = k.conv_id AND own.r > h
), p AS MATERIALIZED (
  SELECT conv_id, depth, string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path, words FROM t
  UNION ALL SELECT conv_id, 0, '', 0 FROM k
), n AS MATERIALIZED (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM p GROUP BY path, depth
), e AS (
  SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM p JOIN k USING (conv_id) WHERE depth = n_turns GROUP BY path
), u AS (
  SELECT n.path, n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, (n.n_convs - 1) * n.words AS saved
  FROM n LEFT JOIN p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 LEFT JOIN n up ON up.path = p.path
), kids AS (
  SELECT p.path, count(*) AS n_children FROM u JOIN p ON p.conv_id = u.conv_id AND p.depth = u.depth - 1 GROUP BY p.path
), below AS (
  SELECT p.path, count(*) FILTER (kids.path IS NULL) AS n_leaves, sum(saved) AS saved_tokens
  FROM u LEFT JOIN kids USING (path) JOIN p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.path
)
SELECT u.conv_id, CAST(u.depth AS BIGINT) AS depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM u JOIN below USING (path) LEFT JOIN kids USING (path) LEFT JOIN e USING (path)
"""
