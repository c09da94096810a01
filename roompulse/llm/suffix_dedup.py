"""Removal of repeated passages with suffix arrays built by bucket-pointer refinement.

Every byte of a document that lies in a ``width``-byte string which also starts earlier (in a document with a
smaller id, or earlier in the same one) is removed. Strings are judged on the input; matches don't cross documents.

1. Anchors. In each window of ``width`` bytes the ``GRAM``-byte gram with the least hash is the window's anchor. Equal
   windows have equal anchors at equal places, so windows with different anchor grams need never meet. Neighbouring
   windows share an anchor; such a run is one row.
2. Grams that occur once in the corpus are dropped: counts are summed per gram, then joined back.
3. For each run left, the bytes that its windows cover (a snippet) are cut from the text. Equal snippets are combined before
   and after the shuffle: all but the earliest are repeats, and only that one has to be sorted.
4. Snippets meet by gram. A block of them is one text whose suffixes are sorted to depth ``width``: the first buckets are
   prefixes of as many bytes as a number holds; then each bucket is refined by the bucket of the suffix at the offset reached so far, and since those
   pointers are the refined ones, the depth doubles with each round. Suffixes of one final bucket are equal
   windows, and all but the earliest are repeats.
5. A gram with more than ``HOT_RUNS`` runs is dealt to several blocks by document. Their buckets' first windows then
   meet once more by the digest of the window, aggregated before the shuffle.
6. Repeated windows are gathered per document and cut out of the text.

NULL ids come before all others, NULL texts are empty, rows with equal ids stand at the same place (so neither
precedes the other at equal starts), texts shorter than ``width`` stay whole, and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm import bytetext
from roompulse.llm.storage import dropped, finished, mapped, named, own_columns, saved
from roompulse.workspace import new_folder

WIDTH = 100
GRAM = 32
#: Windows of a run at most (its place keeps their number in a byte), and the longest strings whose runs fit.
RUN_WINDOWS = 255
MAX_WIDTH = GRAM + RUN_WINDOWS - 1
HOT_RUNS = 8192
#: Work is cut so that its arrays stay in a core's cache; a gram, or a row, is never cut.
BLOCK_BYTES = 1 << 17
SLICE_BYTES = 1 << 17
_STEP = 1 << 17
_PLACE = np.uint64((1 << 24) - 1)
NULL_ID = -(1 << 63)


def runs(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Row, first window start in the row, number of windows and gram hash of each run, and whether its gram stands in it twice."""
    total = len(data)
    empty = np.empty(0, np.int64)
    if total < width:
        return empty, empty, empty, np.empty(0, np.uint64), np.empty(0, bool)
    gram = min(GRAM, width)
    lengths = np.diff(offsets)
    long_enough = lengths >= width
    windows = np.where(long_enough, lengths - width + 1, 0)
    valid = np.repeat(np.tile([True, False], len(lengths)), np.column_stack([windows, lengths - windows]).ravel())
    anchor = np.full(total, -1, np.int64)
    grams = np.zeros(total, np.uint64)
    for first in range(0, total - width + 1, _STEP):
        part = data[first:first + _STEP + width - 1]
        hashes = bytetext.gram_hashes(part, gram)
        grams[first:first + len(hashes)] = hashes
        least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        span, reach = width - gram + 1, 1
        while reach < span:
            step = min(reach, span - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        anchor[first:first + len(least)] = first + (least & _PLACE).astype(np.int64)
    begins = np.zeros(total, bool)
    begins[offsets[:-1][long_enough]] = True
    begins[0] = True
    # Windows with the same gram are one run wherever in them it stands: a text of one letter has few runs.
    value = grams[anchor]
    begins[1:] |= value[1:] != value[:-1]
    starts = np.flatnonzero(begins)
    more = (np.diff(np.append(starts, total)) - 1) // RUN_WINDOWS
    begins[np.repeat(starts, more) + RUN_WINDOWS * (bytetext.ragged(np.zeros(len(more), np.int64), more) + 1)] = True
    first = np.flatnonzero(valid & begins)
    stop = np.append(begins[1:], True)
    stop[:-1] |= ~valid[1:]
    last = np.flatnonzero(valid & stop)
    row = np.searchsorted(offsets, first, side="right") - 1
    return row, first - offsets[row], last - first + 1, grams[anchor[first]], anchor[first] != anchor[last]


def _in_order(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of values below ``limit``, and the sorted values: value and place are sorted as one number where they fit in one."""
    bits = len(values).bit_length()
    if limit.bit_length() + bits > 63:
        order = np.argsort(values)
        return order, values[order]
    packed = values << bits
    packed |= np.arange(len(values))
    packed.sort()
    return packed & ((1 << bits) - 1), packed >> bits


def _parts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of some sorted values, the first place of its like, and whether there are several."""
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])[:len(values)])
    sizes = np.diff(np.append(first, len(values)))
    return np.repeat(first, sizes), np.repeat(sizes > 1, sizes)


def suffix_buckets(text: np.ndarray, first: np.ndarray, count: np.ndarray, width: int) -> np.ndarray:
    """Bucket of each window by bucket-pointer refinement; equal windows share a bucket, and buckets are in sort order.

    Snippet i covers text from first[i] and has count[i] windows; its last one ends where the next snippet begins.
    """
    size = len(text)
    # How far a suffix stands behind its snippet's last window.
    behind = np.arange(size) - np.repeat(first + count, np.diff(np.append(first, size)))
    letter = np.zeros(256, np.int64)
    used = np.flatnonzero(np.bincount(text, minlength=256))
    letter[used] = np.arange(len(used))
    room = 63 - size.bit_length()
    depth = next(k for k in range(min(16, width), 0, -1) if k == 1 or (len(used) ** k).bit_length() <= room)
    # The first buckets are those of prefixes, as numbers to the base of the letters in use.
    code = np.zeros(size, np.int64)
    letters = np.concatenate([letter[text], np.zeros(depth, np.int64)])
    for k in range(depth):
        code *= len(used)
        code += letters[k:k + size]
    steps, limit = [], len(used) ** depth
    while depth < width:
        steps.append(min(depth, width - depth))
        depth += steps[-1]
    # A bucket's number is how many suffixes stand before it, so parts of one get numbers without moving the others.
    bucket = np.zeros(size, np.int64)
    needed = np.flatnonzero(behind < sum(steps))
    order, code = _in_order(code[needed], limit)
    parts, shared = _parts(code)
    open_ = needed[order]
    bucket[open_] = parts
    open_ = open_[shared]
    for k, step in enumerate(steps):
        # A bucket of one is final. The others are sorted by the pointers further on, which earlier rounds have refined.
        open_ = open_[behind[open_] < sum(steps[k + 1:])]
        if not len(open_):
            break
        order, pair = _in_order(bucket[open_] * size + bucket[open_ + step], size * size)
        open_ = open_[order]
        old = pair // size
        parts, shared = _parts(pair)
        bucket[open_] = old + parts - _parts(old)[0]
        open_ = open_[shared]
    found = bucket[bytetext.ragged(first, count)]
    used = np.zeros(size + 1, bool)
    used[found] = True
    return (np.cumsum(used) - 1)[found]


def _true_runs(flags: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of true flags within a group."""
    if not len(flags):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    change = np.append(True, group[1:] != group[:-1])
    first = np.flatnonzero(flags & (change | np.append(True, ~flags[:-1])))
    last = np.flatnonzero(flags & np.append(change[1:] | ~flags[1:], True))
    return first, last - first + 1


FOUND = "kind int, gram long, salt int, salts int, doc_id long, text_key int, start long, windows int, body binary"
PLACES = "kind int, gram long, digest binary, doc_id long, text_key int, start long, windows int"


def _anchor_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytetext.utf8(batch["text"])
            ids, keys = batch["doc_id"].to_numpy(), batch["text_key"].to_numpy()
            for a, b in bytetext.slices(offsets, SLICE_BYTES):
                row, start, count, gram, twice = runs(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width)
                yield pa.RecordBatch.from_arrays([
                    pa.array(gram.view(np.int64)), pa.array(ids[a + row]), pa.array(keys[a + row]),
                    pa.array(start << 8 | count), pa.array(twice)], names=["gram", "doc_id", "text_key", "place", "twice"])

    return run


def _snippets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytetext.utf8(batch["text"])
            raw = memoryview(data.tobytes())
            lists = batch["runs"]
            flat = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            place = flat.field("place").to_numpy()
            begin = offsets[row] + (place >> 8)
            columns = (
                batch["doc_id"].to_numpy()[row], place >> 8, batch["text_key"].to_numpy()[row], place & 255,
                flat.field("gram").to_numpy(), flat.field("salts").to_numpy(), begin, begin + (place & 255) - 1 + width)
            seen: dict[bytes, tuple] = {}
            again: list[tuple] = []
            for doc, start, key, windows, gram, salts, a, b in zip(*(c.tolist() for c in columns), strict=True):
                body = bytes(raw[a:b])
                one = (doc, start, key, windows, gram, salts)
                held = seen.get(body)
                if held is None:
                    seen[body] = one
                elif held[:2] == one[:2]:  # the same place of a repeated row
                    if held[2] != key:
                        again.append((*one, body))
                elif held[:2] <= one[:2]:
                    again.append((*one, None))
                else:
                    again.append((*held, None))
                    seen[body] = one
            rows = [(*one, body) for body, one in seen.items()] + again
            salts = np.array([r[5] for r in rows], np.int64)
            docs = np.array([r[0] for r in rows], np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([int(r[6] is None) for r in rows], pa.int32()), pa.array([r[4] for r in rows], pa.int64()),
                pa.array((bytetext.mix(docs.view(np.uint64)) % np.maximum(salts, 1).astype(np.uint64)).astype(np.int32)),
                pa.array(salts.astype(np.int32)), pa.array(docs), pa.array([r[2] for r in rows], pa.int32()),
                pa.array([r[1] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int32()),
                pa.array([r[6] for r in rows], pa.binary()),
            ], names=["kind", "gram", "salt", "salts", "doc_id", "text_key", "start", "windows", "body"])

    return run


def _combined(rows: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The earliest of each set of equal snippets of a gram, and the others, which are repeats as a whole."""
    body = rows["body"].combine_chunks().dictionary_encode().indices.to_numpy()
    docs, start = rows["doc_id"].to_numpy(), rows["start"].to_numpy()
    several = np.flatnonzero(np.bincount(body)[body] > 1)
    order = several[np.lexsort((start[several], docs[several], body[several]))]
    head = order[_parts(body[order])[0]]
    alone = np.ones(rows.num_rows, bool)
    alone[order] = (docs[order] == docs[head]) & (start[order] == start[head])
    return rows.filter(pa.array(alone)), rows.filter(pa.array(~alone))


def _block(rows: pa.Table, width: int) -> pa.RecordBatch:
    """Repeated windows of a block of snippets (kind 0) and, of dealt grams, each bucket's first window (kind 1)."""
    rows, later = _combined(rows)
    text, offsets = _binary(rows["body"])
    count = rows["windows"].to_numpy().astype(np.int64)
    bucket = suffix_buckets(text, offsets[:-1], count, width)
    snippet = np.repeat(np.arange(len(count)), count)
    inner = bytetext.ragged(np.zeros(len(count), np.int64), count)
    docs, keys = rows["doc_id"].to_numpy(), rows["text_key"].to_numpy()
    start = rows["start"].to_numpy()
    gram, salt, salts = rows["gram"].to_numpy(), rows["salt"].to_numpy(), rows["salts"].to_numpy()
    at = start[snippet] + inner
    several = np.flatnonzero(np.bincount(bucket)[bucket] > 1)
    order = several[np.lexsort((at[several], docs[snippet[several]], bucket[several]))]
    parts = _parts(bucket[order])[0]
    head = order[parts]
    repeated = np.zeros(len(at), bool)
    repeated[order] = (docs[snippet[order]] != docs[snippet[head]]) | (at[order] != at[head])
    first, length = _true_runs(repeated, snippet)
    leads = salts[snippet] > 1
    leads[order[parts != np.arange(len(order))]] = False
    lead = np.flatnonzero(leads)
    begin = offsets[snippet[lead]] + inner[lead]
    raw = memoryview(text.tobytes())
    digests = [hashlib.blake2b(raw[b:b + width], digest_size=16).digest() for b in begin.tolist()]
    n, m, whole = len(first), len(lead), later.num_rows
    pick = snippet[np.concatenate([first, lead])]
    join = lambda own, name: pa.array(np.concatenate([own, later[name].to_numpy()]))
    return pa.RecordBatch.from_arrays([
        pa.array(np.repeat(np.array([0, 1, 0], np.int32), [n, m, whole])), join(gram[pick], "gram"),
        pa.array([None] * n + digests + [None] * whole, pa.binary()), join(docs[pick], "doc_id"),
        join(keys[pick], "text_key"), join(at[np.concatenate([first, lead])], "start"),
        join(np.concatenate([length, np.ones(m, np.int64)]).astype(np.int32), "windows"),
    ], names=["kind", "gram", "digest", "doc_id", "text_key", "start", "windows"])


def _binary(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    values = column.combine_chunks()
    lengths = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(values.buffers()[2], np.uint8)[lengths[0]:lengths[-1]]
    return data, lengths - lengths[0]


def _refine(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            """Work off whole grams; the last one may go on in the next batch."""
            nonlocal held, size
            rows = pa.Table.from_batches(held)
            gram, salt = rows["gram"].to_numpy(), rows["salt"].to_numpy()
            bounds = np.flatnonzero((gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1])) + 1
            bytes_to = np.concatenate([[0], np.cumsum(rows["windows"].to_numpy().astype(np.int64) + width)])
            ends = [*bounds.tolist(), len(gram)] if last else bounds.tolist()
            begin = 0
            for k, end in enumerate(ends):
                if k + 1 == len(ends) or bytes_to[ends[k + 1]] - bytes_to[begin] > BLOCK_BYTES:
                    yield _block(rows.slice(begin, end - begin), width)
                    begin = end
            held = rows.slice(begin).to_batches() if begin < len(gram) else []
            size = sum(b.num_rows for b in held)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size * (width + 40) > BLOCK_BYTES:
                yield from cut(False)
        if held:
            yield from cut(True)

    return run


def _cut_text(width: int, as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytetext.utf8(batch["text"])
            spans, kept, removed = [], [], []
            for i, lists in enumerate(batch["repeats"].to_pylist()):
                text = data[offsets[i]:offsets[i + 1]]
                if not lists:
                    spans.append([])
                    kept.append(text.tobytes())
                    removed.append(0)
                    continue
                edge = np.zeros(len(text) + 1, np.int64)
                first = np.array([x["start"] for x in lists])
                np.add.at(edge, first, 1)
                np.add.at(edge, first + np.array([x["windows"] for x in lists]) - 1 + width, -1)
                gone = np.cumsum(edge[:-1]) > 0
                begin, length = _true_runs(gone, np.zeros(len(gone), np.int8))
                spans.append(np.column_stack([begin, begin + length]).ravel().tolist())
                kept.append(text[~gone].tobytes())
                removed.append(int(gone.sum()))
            own = [c for c in batch.schema.names if c.startswith("own_")]
            out = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
                pa.array(spans, pa.list_(pa.int64())), out, *(batch[c] for c in own),
            ], names=["doc_id", "n_bytes", "n_removed", "spans", "kept", *own])

    return run


def repeats_removed(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
                    carry: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, removed byte spans (flat first, end) and the bytes kept, one row per document row.

    Columns named in ``carry`` go along, with ``own_`` before their names. With ``as_text`` what is kept is a string,
    and a character of which a cut left only some bytes is left out of it.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.coalesce(named(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"), named(text_col).alias("text"),
        F.hash(named(text_col)).alias("text_key"), *(named(c).alias(f"own_{c}") for c in carry))
    if width > MAX_WIDTH:
        raise ValueError(f"strings of {width} bytes: a run of windows would not fit its place")
    texts = base.select("doc_id", "text_key", "text")
    anchors = texts.transform(mapped, _anchor_rows(width), "gram long, doc_id long, text_key int, place long, twice boolean")
    counts = anchors.groupBy("gram").agg(F.count("*").alias("n"), F.max("twice").alias("twice")).where("n > 1 or twice").select(
        "gram", F.ceil(F.col("n") / HOT_RUNS).cast("int").alias("salts"))
    old = [new_folder(spark, "grams"), new_folder(spark, "runs")]
    counts = saved(counts, "grams", old[0])
    finished(spark)
    shared = saved(anchors.drop("twice").join(counts, "gram"), "runs", old[1])
    finished(spark)
    lists = shared.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("gram", "salts", "place")).alias("runs"))
    found = saved(texts.join(lists, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "runs").transform(
        mapped, _snippets(width), FOUND), "snippets")
    finished(spark)
    dropped(spark, *old)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = saved(
        found.where("kind = 0").repartition(tasks, "gram", "salt").sortWithinPartitions("gram", "salt")
        .transform(mapped, _refine(width), PLACES), "places")
    finished(spark)
    heads = places.where("kind = 1")
    at = F.struct("doc_id", "start")
    earliest = heads.groupBy("gram", "digest").agg(F.min(at).alias("head"), F.count("*").alias("n")).where("n > 1")
    later = heads.join(earliest, ["gram", "digest"]).where(at != F.col("head"))
    columns = ["doc_id", "text_key", "start", "windows"]
    repeats = found.where("kind = 1").select(columns).unionByName(places.where("kind = 0").select(columns)).unionByName(
        later.select(columns))
    lists = saved(repeats.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("start", "windows")).alias("repeats")), "repeats")
    finished(spark)
    schema = f"doc_id long, n_bytes long, n_removed long, spans array<long>, kept {'string' if as_text else 'binary'}" + own_columns(base)
    out = base.join(lists, ["doc_id", "text_key"], "left").drop("text_key").transform(mapped, _cut_text(width, as_text), schema)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 100-byte strings that start earlier."""
    from roompulse.llm.storage import table

    return saved(repeats_removed(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256")), "deduplicated")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS win
  FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) AS BIGINT) // 2 - 99)) AS p FROM d WHERE length(h) >= 200)
), later AS (
  SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, p) > 1
), islands AS (
  SELECT doc_id, p, sum(CASE WHEN gap IS NULL OR gap > 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS island
  FROM (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM later)
), spans AS (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM islands GROUP BY doc_id, island
), cuts AS (
  SELECT doc_id, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends, sum(b - a) AS n_removed, count(*) AS n_spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       CASE WHEN n_spans IS NULL THEN sha256(unhex(h)) ELSE sha256(unhex(list_aggregate(list_transform(
         range(0, n_spans + 1),
         lambda k: substr(h, CASE WHEN k = 0 THEN 1 ELSE 2 * ends[k] + 1 END,
           2 * (CASE WHEN k = n_spans THEN length(h) // 2 ELSE starts[k + 1] END - CASE WHEN k = 0 THEN 0 ELSE ends[k] END))
       ), 'string_agg', ''))) END AS kept_sha256
FROM d LEFT JOIN cuts USING (doc_id)
"""
