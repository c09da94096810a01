"""Harmonic packing of token sequences into rows of fixed capacity.

A document's ids are cut where that saves padding and its pieces sorted into reciprocal classes: class j
takes lengths in (capacity / (j + 1), capacity / j], and each sequence of class j takes exactly j pieces. A
piece stays whole where its slot of capacity / j wastes at most ``SLACK`` of it; else the largest exact
slot is cut off and the rest goes on. Whole sequences (class 1) are cut off first.

Each worker numbers its own pieces per class. Per class and worker only a count leaves it; prefix sums of
those counts give each worker its first bin, and from there it fills bins on its own: piece r of class j is in bin
r // j. The last bin of each class may be short. There are fewer than 2 * sqrt(capacity) classes, so these few
are merged first-fit-decreasing on the driver.

A document has its end id at least, so NULL and empty texts are pieces of one id; equal doc_ids stay apart by their row
in the piece table; an empty table gives no pieces; a text of any length is encoded whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roompulse.llm import bytetext
from roompulse.llm.encoding import PieceEncoder, encoding_task
from roompulse.llm.storage import documents, mapped, saved

CAPACITY = 2048
SLACK = 0.04
PIECES = ("doc_id long, start long, length long, doc_tokens long, class int, worker int, rank long, ids binary")


def cuts(length: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        slot = capacity // (capacity // rest)
        if slot - rest <= SLACK * rest:
            out.append(rest)
            break
        piece = capacity // (capacity // rest + 1)
        out.append(piece)
        rest -= piece
    return out


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and cut whole documents; each piece has its ids, class, and rank in the class within its worker."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoding_task(tokenizer) as encoder:
            yield from cut_with(encoder, batches)

    def cut_with(encoder: PieceEncoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = TaskContext.get().partitionId()
        ranks: dict[int, int] = defaultdict(int)
        known: dict[int, list[int]] = {}
        for batch in batches:
            data, offsets = bytetext.utf8(batch["text"])
            doc_ids = batch["doc_id"]
            for first, last in bytetext.slices(offsets):
                ids, counts = encoder.encode(
                    data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
                ends = np.cumsum(counts)
                wide = np.insert(ids, ends, end_id).astype("<u4")
                row, start, length, place = [], [], [], 0
                sizes = (counts + 1).tolist()
                for i, size in enumerate(sizes):
                    parts = known.get(size) or known.setdefault(size, cuts(size, capacity))
                    at = 0
                    for part in parts:
                        row.append(i)
                        start.append(at)
                        length.append(part)
                        at += part
                bounds = np.cumsum([0, *length])
                classes = [capacity // n for n in length]
                rank = []
                for j in classes:
                    rank.append(ranks[j])
                    ranks[j] += 1
                row = np.array(row, np.int64)
                yield pa.RecordBatch.from_arrays([
                    doc_ids.slice(first, last - first).take(pa.array(row)).cast(pa.int64()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(np.array(sizes)[row], pa.int64()), pa.array(classes, pa.int32()),
                    pa.array(np.full(len(row), worker), pa.int32()), pa.array(rank, pa.int64()),
                    bytetext.binaries(wide, bounds),
                ], names=["doc_id", "start", "length", "doc_tokens", "class", "worker", "rank", "ids"])

    return saved(documents(docs, id_col, text_col).transform(mapped, cut, PIECES), "pieces")


def _merged_tails(tails: list[tuple[int, int]], capacity: int) -> dict[int, int]:
    """First-fit-decreasing of the classes' last bins: the class whose bin each one joins."""
    home: dict[int, int] = {}
    room: list[list[int]] = []
    for size, j in sorted(((size, j) for j, size in tails), reverse=True):
        for bin_ in room:
            if bin_[1] >= size:
                bin_[1] -= size
                home[j] = bin_[0]
                break
        else:
            room.append([j, capacity - size])
            home[j] = j
    return home


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` of each piece; other columns stay as they are."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("class", "worker").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("class", "worker", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["class", "worker"]).withColumn("rank", F.col("rank") + F.col("base")).drop("base")

    # One row per class: its number of bins, and the size of its last one where that is short.
    totals = {r["class"]: r["n"] for r in pieces.groupBy("class").agg(F.count("*").alias("n")).collect()}
    short = {j: n - n % j for j, n in totals.items() if n % j}
    tails = []
    if short:
        limits = spark.createDataFrame(list(short.items()), "class int, from_rank long")
        last = ranked.join(F.broadcast(limits), "class").where("rank >= from_rank")
        tails = [(r["class"], r["size"]) for r in last.groupBy("class").agg(F.sum("length").alias("size")).collect()]
    home = _merged_tails(tails, capacity)
    first, plan = 0, []
    bin_of: dict[int, int] = {}
    for j, n in sorted(totals.items()):
        bins = n // j + (home.get(j) == j)
        if home.get(j) == j:
            bin_of[j] = first + bins - 1
        plan.append([j, n - n % j, first])
        first += bins
    rows = [(j, full, base, bin_of.get(home.get(j, j), -1)) for j, full, base in plan]
    table = spark.createDataFrame(rows, "class int, full long, first_bin long, tail_bin long")
    binned = ranked.join(F.broadcast(table), "class").withColumn(
        "sequence_id",
        F.when(F.col("rank") < F.col("full"), F.col("first_bin") + F.floor(F.col("rank") / F.col("class")))
        .otherwise(F.col("tail_bin")).cast("long"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return binned.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("full", "first_bin", "tail_bin")


def packed(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """All pieces of all documents with their places; without ids, only a crc32 of them is carried."""
    pieces = token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col)
    if not with_ids:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(pieces, capacity)


DIGEST = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 2048 tokens."""
    from roompulse.llm.encoding import tokenizer_path
    from roompulse.llm.storage import table

    return packed(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1,
                  with_ids=False).select(*DIGEST)
