"""Token-id files: flat unsigned integers and 64-bit document offsets, read back by memory map, or by range where the
store isn't local.

Documents are encoded where they lie; their token ids are dealt to partitions by ranges of document ids and sorted, so the
partitions' files in order are the corpus in ascending ``doc_id`` order (NULL ids first). Each task writes

* ``<name>.ids``: the token ids of its documents, little-endian, 2 bytes each where the vocabulary allows, else 4;
* ``<name>.off``: n + 1 offsets into them, signed 64-bit little-endian;
* ``<name>.doc``: the n document ids, signed 64-bit (a NULL id is the least value).

under a name of its own, and returns one manifest row. Only rows of committed attempts reach the manifest,
so a lost executor leaves at most an unused file behind. The base of a partition is the prefix sum of the
token counts of those before it: one row per partition, never one per document.

NULL and empty texts have the end id alone; repeated ids stay separate documents; texts of any length are
encoded whole; an empty table gives an empty manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roompulse.llm import bytetext
from roompulse.llm.encoding import encoding_task
from roompulse.llm.storage import documents, mapped, saved
from roompulse.workspace import new_folder

NULL_ID = -(1 << 63)
MANIFEST = "worker int, name string, docs long, tokens long"
BATCH_DOCS, BATCH_TOKENS = 1000, 1 << 21


def _store(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _width(path: str) -> int:
    with open(path, encoding="utf-8") as file:
        tokenizer = json.load(file)
    largest = max([*tokenizer["model"]["vocab"].values(), *(t["id"] for t in tokenizer.get("added_tokens") or [])])
    return 2 if largest < 1 << 16 else 4


def _id(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def _part(ids: DataFrame, count: int) -> Column:
    """The partition of a document, in ascending order of ids and with nearly as many rows as the others.

    Borders are approximate quantiles of the ids, so nothing is encoded for a sample. An id with the rows of several
    partitions is dealt to all of those that it alone fills, by its text.
    """
    borders = ids.agg(F.percentile_approx("id", [k / count for k in range(1, count)], 100 * count)).first()[0] if count > 1 else None
    if not borders:
        return F.lit(0)
    sorted_borders = F.lit(sorted(borders))
    low, high = (F.size(F.filter(sorted_borders, keep)) for keep in (lambda b: b < _id("doc_id"), lambda b: b <= _id("doc_id")))
    return (low + F.pmod(F.xxhash64("text"), high - low + 1)).cast("int")


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files of a corpus below a shared folder; returns their manifest with bases."""
    spark, width = docs.sparkSession, _width(tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoding_task(tokenizer) as encoder:
            for batch in batches:
                data, offsets = bytetext.utf8(batch["text"])
                for first, last in bytetext.slices(offsets):
                    ids, counts = encoder.encode(
                        data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
                    ends = np.cumsum(counts)
                    whole = np.insert(ids, ends, end_id).astype(f"<u{width}")
                    bounds = np.append(0, ends + np.arange(1, len(ends) + 1))
                    yield pa.RecordBatch.from_arrays([
                        batch["doc_id"].slice(first, last - first).cast(pa.int64()), batch["part"].slice(first, last - first),
                        bytetext.binaries(whole, bounds),
                    ], names=["doc_id", "part", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        worker = TaskContext.get().partitionId()
        name = f"part-{worker:06d}-{uuid.uuid4().hex}"
        docs_done = tokens_done = 0
        with store.open_output_stream(f"{root}/{name}.ids") as ids_file, \
                store.open_output_stream(f"{root}/{name}.off") as off_file, \
                store.open_output_stream(f"{root}/{name}.doc") as doc_file:
            off_file.write(np.zeros(1, "<i8").tobytes())
            for batch in batches:
                doc_file.write(batch["doc_id"].fill_null(NULL_ID).to_numpy().astype("<i8").tobytes())
                sizes = pc.binary_length(batch["ids"]).to_numpy().astype("<i8") // width
                for ids in batch["ids"]:
                    ids_file.write(ids.as_buffer())
                off_file.write((tokens_done + np.cumsum(sizes)).astype("<i8").tobytes())
                tokens_done += int(sizes.sum())
                docs_done += batch.num_rows
        if docs_done:
            yield pa.RecordBatch.from_pydict({
                "worker": pa.array([worker], pa.int32()), "name": [name], "docs": [docs_done], "tokens": [tokens_done]})

    # Ids are a fraction of the text: they are what is shuffled and sorted.
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = documents(docs, id_col, text_col).withColumn("part", _part(docs.select(_id(id_col).alias("id")), count))
    encoded = placed.transform(mapped, encode, "doc_id long, part int, ids binary")
    parts = encoded.repartitionById(count, "part").sortWithinPartitions("doc_id").drop("part")
    manifest = saved(parts.transform(mapped, write, MANIFEST), "manifest", f"{folder}/manifest")
    before = Window.orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select(
        F.lit(folder).alias("folder"), F.lit(width).alias("width"), "*",
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"),
    )


class _Ranges:
    """Slices of a file of integers, by memory map where it is local, else by range reads."""

    def __init__(self, store: pa.fs.FileSystem, path: str, kind: str):
        self.kind = np.dtype(kind)
        self.local = np.memmap(path, dtype=kind, mode="r") if isinstance(store, pa.fs.LocalFileSystem) else None
        self.file = store.open_input_file(path) if self.local is None else None

    def __getitem__(self, part: slice) -> np.ndarray:
        if self.file is None:
            return self.local[part]
        self.file.seek(part.start * self.kind.itemsize)
        wanted = (part.stop - part.start) * self.kind.itemsize
        found = np.frombuffer(self.file.read(wanted), dtype=self.kind)
        if found.nbytes != wanted:
            raise EOFError(f"{wanted} bytes from item {part.start} on wanted, {found.nbytes} read")
        return found

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


@contextmanager
def _ranges(store: pa.fs.FileSystem, path: str, kind: str) -> Iterator[_Ranges]:
    ranges = _Ranges(store, path, kind)
    try:
        yield ranges
    finally:
        ranges.close()


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start in the corpus, and its ids (little-endian unsigned 32-bit)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                store, root = _store(part["folder"])
                path = f"{root}/{part['name']}"
                with _ranges(store, f"{path}.ids", f"<u{part['width']}") as ids, \
                        _ranges(store, f"{path}.off", "<i8") as off, _ranges(store, f"{path}.doc", "<i8") as doc:
                    for first in range(0, part["docs"], BATCH_DOCS):
                        last = min(first + BATCH_DOCS, part["docs"])
                        borders, names = off[first:last + 1], np.asarray(doc[first:last])
                        for a, b in bytetext.slices(np.asarray(borders), BATCH_TOKENS):
                            some = borders[a:b + 1]
                            block = ids[int(some[0]):int(some[-1])].astype("<u4")
                            yield pa.RecordBatch.from_arrays([
                                pa.array(names[a:b], pa.int64(), mask=names[a:b] == NULL_ID),
                                pa.array(part["base"] + some[:-1], pa.int64()), bytetext.binaries(block, some - some[0]),
                            ], names=["doc_id", "start", "ids"])

    # A stated count keeps adaptive execution from reading all files in one task.
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = manifest.repartition(tasks, "name")
    return parts.transform(mapped, read, "doc_id long, start long, ids binary")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token-id files, read them back, one digest row per document."""
    from roompulse.llm.encoding import tokenizer_path
    from roompulse.llm.storage import table

    manifest = write_token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                 new_folder(spark, "token-files"), end_id=0)
    return read_token_files(manifest).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
