"""Shards of near-equal size from indivisible groups, by best-fit-decreasing bin packing.

Groups (documents with equal text) are sorted by size and each enters the tightest bin that still has room,
found through a balanced tree of remaining capacities. That runs twice: first each worker packs its own groups into
parcels of 1/``PARCELS`` of a shard, then the parcels of all workers are packed into the shards, at the
smallest capacity for which the wanted number of shards is enough. A group larger than a parcel is a parcel by itself;
one larger than an even shard gets a shard of its own. Only one row per parcel reaches the driver: twice
``PARCELS`` per shard and one per worker at most, whatever the number of documents.

NULL and empty texts are one group of size-1 documents; documents with equal ids are counted and placed
row by row; an empty table gives no rows; sizes are whole UTF-8 lengths plus one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roompulse.llm.storage import documents, mapped, saved

SHARDS = 8
PARCELS = 1024
SLOT_ROWS = 20_000


class RoomTree:
    """A treap of (room, bin): insert, remove, and the least room of at least a given size."""

    def __init__(self) -> None:
        self.root: list | None = None  # [room, bin, priority, left, right]

    @staticmethod
    def _merge(a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return a or b
        if a[2] > b[2]:
            a[4] = RoomTree._merge(a[4], b)
            return a
        b[3] = RoomTree._merge(a, b[3])
        return b

    @staticmethod
    def _split(node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        """Nodes below the key, and the others."""
        if node is None:
            return None, None
        if (node[0], node[1]) < key:
            node[4], rest = RoomTree._split(node[4], key)
            return node, rest
        rest, node[3] = RoomTree._split(node[3], key)
        return rest, node

    def insert(self, room: int, bin_: int) -> None:
        priority = (bin_ * 0x9E3779B97F4A7C15 ^ room * 0xBF58476D1CE4E5B9) & (1 << 64) - 1
        low, high = self._split(self.root, (room, bin_))
        self.root = self._merge(self._merge(low, [room, bin_, priority, None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the (room, bin) with the least room that holds the size."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        parent, node = None, high
        while node[3] is not None:
            parent, node = node, node[3]
        if parent is None:
            high = node[4]
        else:
            parent[3] = node[4]
        self.root = self._merge(low, high)
        return node[0], node[1]


class BestFit:
    """Bins of one capacity; a larger item gets a bin of its own."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.tree = capacity, 0, RoomTree()

    def add(self, size: int) -> int:
        found = self.tree.take_tightest(size)
        room, bin_ = found or (max(self.capacity, size), self.bins)
        if found is None:
            self.bins += 1
        if room > size:
            self.tree.insert(room - size, bin_)
        return bin_


def _placed(sizes: list[int], shards: int) -> list[int]:
    """Shard of each size (given in decreasing order): best fit at the smallest capacity that needs no more shards."""
    out, first = [], 0
    total = sum(sizes)
    while shards - first > 1 and first < len(sizes) and sizes[first] * (shards - first) > total:
        out.append(first)
        total -= sizes[first]
        first += 1
    rest, bins = sizes[first:], shards - first
    if not rest:
        return out

    def pack(capacity: int) -> list[int] | None:
        fit = BestFit(capacity)
        homes = []
        for size in rest:
            homes.append(fit.add(size))
            if fit.bins > bins:
                return None
        return homes

    low, high = max(rest[0], -(-total // bins)), -(-total // bins) + rest[0]
    best = pack(high)
    while best is None:  # at an even share plus the largest item some bin always has room
        high += rest[0]
        best = pack(high)
    while low < high:
        middle = (low + high) // 2
        homes = pack(middle)
        if homes is None:
            low = middle + 1
        else:
            best, high = homes, middle
    return out + [first + home for home in best]


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, group_key, shard and slot of each document."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    base = saved(documents(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("group_key")), "sized")
    groups = base.groupBy("group_key").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    total, rows = base.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    parcel = max(1, math.ceil(total / (shards * PARCELS)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, fit = TaskContext.get().partitionId(), BestFit(parcel)
        for batch in batches:
            homes = [fit.add(size) for size in batch["bytes"].to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch["group_key"], batch["bytes"], pa.array([worker] * len(homes), pa.int32()), pa.array(homes, pa.int64()),
            ], names=["group_key", "bytes", "worker", "parcel"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = groups.repartition(tasks, "group_key").sortWithinPartitions(F.desc("bytes"), "group_key")
    parcels = saved(dealt.transform(mapped, pack, "group_key string, bytes long, worker int, parcel long"), "parcels")
    summed = parcels.groupBy("worker", "parcel").agg(F.sum("bytes").alias("bytes")).collect()
    summed.sort(key=lambda r: (-r["bytes"], r["worker"], r["parcel"]))
    homes = _placed([r["bytes"] for r in summed], shards)
    plan = spark.createDataFrame([(r["worker"], r["parcel"], home) for r, home in zip(summed, homes, strict=True)],
                                 "worker int, parcel long, shard int")

    # Slots: rows are dealt to blocks by id within their shard, and each block starts where those before it end.
    blocks = max(1, math.ceil(rows / shards / SLOT_ROWS))
    assigned = saved(
        base.join(parcels.drop("bytes"), "group_key").join(plan, ["worker", "parcel"])
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "group_key"), F.lit(blocks))).drop("worker", "parcel"), "assigned")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = assigned.groupBy("shard", "block").agg(F.count("*").alias("n")).select(
        "shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "group_key")) - 1
    return assigned.withColumn("rank", rank).join(first, ["shard", "block"]).withColumn(
        "slot", (F.col("first") + F.col("rank")).cast("long")).drop("rank", "first", "block")


def op5_best_fit_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes, equal texts together."""
    from roompulse.llm.storage import table

    return shard_by_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
