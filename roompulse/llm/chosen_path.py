"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct word shingles; two are linked where their Jaccard similarity is at least
``percent``. Documents with equal sets are one node from the start.

1. Every node gets ``TOKENS`` minwise tokens. Each of ``TREES`` independent trees branches all nodes by one of them.
   A branch of more than ``LEAF`` nodes is branched again, each node by two further tokens, down to ``LEVELS``. A pair of
   similarity 0.8 meets in some leaf with a probability above 1 - 1e-6 (1 - 4e-9 where nothing is branched twice).
2. Leaves are compared exhaustively on the tokens: so many must be equal that a pair at the threshold has fewer with a
   probability below 1e-7 by the binomial law (33 of 64 at 0.8). Step 3 uses the same limit on the same tokens. The pairs found are chained, so a leaf gives fewer rows than it has nodes. Leaves still larger than ``BLOCK`` after the
   last level are compared in pairs of blocks.
3. The connected groups of these candidates hold all links. Each document's whole set is sent to its group once, and
   links are confirmed on the sets; nodes that are already connected needn't be compared. Groups beyond ``BLOCK``
   nodes are again compared in pairs of blocks.
4. The components of the confirmed links are the result.

Words are runs of bytes other than 0x20 and 0x09 to 0x0D, A to Z in lower case. With fewer words than a shingle the whole
sequence is the one shingle. Documents without words (NULL and empty texts too) are linked with nothing and are their own
component. Rows with equal ids and texts fall into one component; NULL ids are never the smallest one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm import bytetext
from roompulse.llm.components import components
from roompulse.llm.storage import finished, mapped, saved

WORDS = 5
PERCENT = 80
TOKENS = 64
TREES = 12
LEAF = 256
LEVELS = 3
BLOCK = 2048
LOSS = 1e-7

_random = np.random.default_rng(20)
_FACTORS = _random.integers(0, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 1 << 63, TOKENS, dtype=np.uint64)
_PLACES = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    data = bytetext.lower(data)
    starts, ends, first = bytetext.words(data, offsets)
    hashes = bytetext.span_hashes(data, starts, ends)
    whole = np.zeros(len(hashes), np.uint64)
    for k in range(min(words, len(hashes))):
        whole[:len(hashes) - k] += hashes[k:] * _PLACES[k]
    whole = bytetext.mix(whole)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(whole[a:b - words + 1]))
        elif b > a:
            short = (hashes[a:b] * _PLACES[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(bytetext.mix(np.array([short], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set."""
    out = np.full(TOKENS, np.uint64((1 << 64) - 1))
    for at in range(0, len(shingles), 8192):
        part = shingles[at:at + 8192, None] * _FACTORS + _SHIFTS
        np.minimum(out, part.min(axis=0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _profiles(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytetext.utf8(batch["text"])
            sizes, nodes, tokens = [], [], []
            for a, b in bytetext.slices(offsets):
                for shingles in shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], words):
                    sizes.append(len(shingles))
                    nodes.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                    tokens.append(minwise(shingles).tolist() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], batch["text_key"], pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                pa.array(tokens, pa.list_(pa.int32()))], names=["doc_id", "text_key", "n_shingles", "node", "tokens"])

    return run


def least_tokens(percent: int) -> int:
    """How many tokens a pair must share to be compared; at the threshold it has fewer with a probability below ``LOSS``."""
    share, below = percent / 100, 0.0
    for k in range(TOKENS + 1):
        below += math.comb(TOKENS, k) * share**k * (1 - share)**(TOKENS - k)
        if below >= LOSS:
            return k
    return TOKENS


def _chain(tokens: np.ndarray, sizes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs that connect what is connected by candidate pairs; each node is compared with those not reached yet."""
    least = least_tokens(percent)
    left, out = np.arange(len(sizes)), []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            fits = (sizes[left] * 100 >= sizes[x] * percent) & (sizes[x] * 100 >= sizes[left] * percent)
            near = fits.copy()
            near[fits] = (tokens[left[fits]] == tokens[x]).sum(axis=1) >= least
            found = left[near].tolist()
            out.extend((x, y) for y in found)
            queue.extend(found)
            left = left[~near]
    return out


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of each key, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[k].to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        bounds = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _pairs_of(nodes: list[bytes], pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([nodes[a] for a, _ in pairs], pa.binary()),
                                       pa.array([nodes[b] for _, b in pairs], pa.binary())], names=["u", "v"])


def _compare_leaves(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[bytes] = []
        pairs: list[tuple[int, int]] = []
        for leaf in _grouped(batches, ["branch", "i", "j"]):
            own = leaf["node"].to_pylist()
            if len(own) < 2:
                continue
            tokens = leaf["tokens"].combine_chunks().flatten().to_numpy().reshape(len(own), TOKENS)
            first = len(nodes)
            found = _chain(tokens, leaf["n_shingles"].to_numpy(), percent)
            if found:
                nodes += own
                pairs += [(first + a, first + b) for a, b in found]
            if len(pairs) > 10_000:
                yield _pairs_of(nodes, pairs)
                nodes, pairs = [], []
        yield _pairs_of(nodes, pairs)

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytetext.utf8(batch["text"])
            wanted = batch["node"].to_pylist()
            body: list[bytes | None] = []
            for a, b in bytetext.slices(offsets):
                for shingles in shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], words):
                    same = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() == wanted[len(body)]
                    body.append(shingles.tobytes() if same else None)
            yield pa.RecordBatch.from_arrays([batch["node"], batch["label"], batch["blocks"], pa.array(body, pa.binary())],
                                             names=["node", "label", "blocks", "shingles"])

    return run


def _confirmed(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what is connected by links; each set is compared with those not reached yet."""
    sizes = np.array([len(s) for s in sets])
    tokens = np.stack([minwise(s) for s in sets])
    least = least_tokens(percent)
    left, out = np.arange(len(sets)), []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            fits = (sizes[left] * 100 >= sizes[x] * percent) & (sizes[x] * 100 >= sizes[left] * percent)
            near = fits.copy()
            near[fits] = (tokens[left[fits]] == tokens[x]).sum(axis=1) >= least
            linked = []
            for k in np.flatnonzero(near).tolist():
                other = sets[left[k]]
                place = np.searchsorted(sets[x], other)
                place[place == len(sets[x])] = 0
                common = int((sets[x][place] == other).sum())
                if 100 * common >= percent * (len(other) + len(sets[x]) - common):
                    linked.append(k)
            found = left[linked].tolist()
            out.extend((x, y) for y in found)
            queue.extend(found)
            left = np.delete(left, linked)
    return out


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, ["label", "i", "j"]):
            nodes, sets, seen = [], [], set()
            for node, body in zip(group["node"].to_pylist(), group["shingles"].to_pylist(), strict=True):
                if node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    sets.append(np.frombuffer(body, np.uint64))
            if len(nodes) > 1:
                yield _pairs_of(nodes, _confirmed(sets, percent))

    return run


def _block_pairs(rows: DataFrame, node: str = "node") -> DataFrame:
    """Rows with the block pairs (i, j) they take part in; all of a group's pairs of nodes meet in some pair of blocks."""
    own = F.pmod(F.xxhash64(F.lit("block"), node), F.col("blocks"))
    return rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn(
        "i", F.least("own", "other").cast("int")).withColumn("j", F.greatest("own", "other").cast("int")).drop("own", "other", "blocks")


def _branches(nodes: DataFrame) -> DataFrame:
    """Leaves of all trees: branch, n (nodes in it) and node."""
    token = lambda k: F.get("tokens", k)
    live = nodes.select("node", F.explode(F.array(*(
        F.struct(F.lit(t).alias("tree"), F.xxhash64(F.lit(t), token(F.lit(t))).alias("branch")) for t in range(TREES)))).alias("b")
    ).select("node", "b.tree", "b.branch")
    leaves = None
    for level in range(1, LEVELS + 1):
        counts = live.groupBy("branch").agg(F.count("*").alias("n")).where("n > 1")
        live = saved(live.join(counts, "branch"), f"level-{level}")
        done = live if level == LEVELS else live.where(F.col("n") <= LEAF)
        done = done.select("branch", "n", "node")
        leaves = done if leaves is None else leaves.unionByName(done)
        large = live.where(F.col("n") > LEAF)
        if level == LEVELS or large.isEmpty():
            break
        at = lambda b: (F.col("tree") * 5 + 2 * (level - 1) + b) % (TOKENS - TREES) + TREES
        live = large.join(nodes.select("node", "tokens"), "node").select("node", "tree", F.explode(F.array(*(
            F.xxhash64("branch", F.lit(b), token(at(b))) for b in range(2)))).alias("branch"))
    return leaves


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (a hash of the text), n_shingles, label and component_id of each row.

    ``label`` is the component itself (NULL without words); unlinked rows with equal ids share ``component_id`` only.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(F.col(text_col)).alias("text_key"))
    rows = saved(texts.transform(
        mapped, _profiles(words), "doc_id long, text_key long, n_shingles long, node binary, tokens array<int>"), "profiles")
    nodes = saved(rows.where("node is not null").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.min("doc_id").alias("smallest"),
        F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens")), "nodes")

    leaves = _branches(nodes).withColumn("blocks", F.ceil(F.col("n") / BLOCK)).drop("n")
    full = leaves.join(nodes.select("node", "n_shingles", "tokens"), "node")
    candidates = saved(
        _block_pairs(full).repartition(tasks, "branch", "i", "j").sortWithinPartitions("branch", "i", "j")
        .transform(mapped, _compare_leaves(percent), "u binary, v binary"), "candidates")
    finished(spark)
    groups = components(candidates, "groups")
    sizes = groups.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    wanted = groups.join(sizes, "label").join(nodes.select("node", "first"), "node").select(
        "node", "label", "blocks", F.col("first.doc_id").alias("doc_id"), F.col("first.text_key").alias("text_key"))
    match = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["text_key"] == wanted["text_key"])
    bodies = texts.join(wanted, match).select("node", "label", "blocks", "text").transform(
        mapped, _sets(words), "node binary, label binary, blocks long, shingles binary").where("shingles is not null")
    links = saved(
        _block_pairs(bodies).repartition(tasks, "label", "i", "j").sortWithinPartitions("label", "i", "j")
        .transform(mapped, _confirm(percent), "u binary, v binary"), "links")
    finished(spark)
    linked = components(links, "linked")
    labelled = nodes.select("node", "smallest").join(linked, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = labelled.groupBy("label").agg(F.min("smallest").alias("component_id"))
    of_node = labelled.join(smallest, "label").select("node", "label", "component_id")
    return rows.drop("tokens").join(of_node, "node", "left").select(
        "doc_id", "text_key", "n_shingles", "label", F.coalesce("component_id", "doc_id").alias("component_id"))


def op3_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents on four-word shingles."""
    from roompulse.llm.storage import table

    return near_duplicates(table(spark, sf_dir, "documents"), words=4).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, list_aggregate(w[k:k + 3], 'string_agg', ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY ALL
), links AS (
  SELECT u, v FROM pairs JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * common >= 80 * (a.n + b.n - common)
), sides AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION
  SELECT reach.u, sides.v FROM reach JOIN sides ON reach.v = sides.u
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u) c USING (doc_id)
"""
