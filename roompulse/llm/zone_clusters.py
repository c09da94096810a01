"""Centroid clustering over zone maps: vectors in Hilbert order, blocks with boxes, exact integer arithmetic.

Components become integers, ``floor(SCALE * x)``. Vectors are sorted along a Hilbert curve (two bits per component, cut
at the mean and one standard deviation around it) and cut into blocks of ``BLOCK`` rows; a block's row holds its
vectors and their least and greatest value per component, the box. In each round a block keeps those centroids whose
least possible distance to its box isn't above the least greatest one, and compares only these with its vectors,
all at once. Ties go to the smaller centroid number, and a centroid that ties can't be excluded by its bound, so the result
is that of comparing everything.

The blocks are written once and read in every round. A task adds its vectors up per centroid, one number per centroid and
component, so what crosses the shuffle and reaches the driver is bounded by the centroids, whatever the number of vectors.
``k`` centroids must fit into a task's memory; the vectors of one block do as well.

A vector takes part if it has exactly ``dims`` components, none NULL, NaN or infinite; others give no row. A component beyond
±2**27 after scaling raises, since squared distances would leave 64 bits. Rows with equal ids are vectors of their own, a NULL
id counts as an empty one in the hash that orders the first centroids, and ties there are ordered by the vectors. Equal
vectors are dealt to many tasks by their row's place. With fewer than ``k`` vectors there are as many centroids as
vectors; an empty table gives no rows. Other columns are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roompulse.llm.storage import dropped, finished, mapped, saved
from roompulse.session import session_conf
from roompulse.workspace import new_folder

SCALE = 256
BLOCK = 1024
BITS = 2
LIMIT = 1 << 27
#: Block rows of an Arrow batch.
BATCH_BLOCKS = 32
BLOCKS = "ids array<long>, vectors binary, low binary, high binary"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The places of integer points (rows of ``bits``-bit coordinates) on the Hilbert curve, as big-endian bytes."""
    x = cells.astype(np.uint8).copy()
    dims = x.shape[1]
    for bit in range(bits - 1, 0, -1):
        low = np.uint8((1 << bit) - 1)
        for i in range(dims):
            turned = (x[:, i] >> bit & 1).astype(bool)
            swapped = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & low).astype(np.uint8)
            x[:, 0] ^= np.where(turned, low, swapped).astype(np.uint8)
            x[:, i] ^= swapped
    x = np.bitwise_xor.accumulate(x, axis=1)
    turn = np.zeros(len(x), np.uint8)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] >> bit & 1, (1 << bit) - 1, 0).astype(np.uint8)
    x ^= turn[:, None]
    planes = [x >> bit & 1 for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1), axis=1)


def nearest(vectors: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of and squared distance to each vector's nearest centroid, and how many centroids the box left."""
    outside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    least = (outside * outside).sum(axis=1)
    reach = np.maximum(np.abs(centroids - low), np.abs(high - centroids))
    candidates = np.flatnonzero(least <= (reach * reach).sum(axis=1).min())
    some = centroids[candidates]
    widest = max(int(np.abs(some).max()), int(np.abs(low).max()), int(np.abs(high).max()))
    if 4 * widest * widest * vectors.shape[1] < 1 << 53:  # whole numbers of this size are exact in floating point
        floats, others = vectors.astype(np.float64), some.astype(np.float64)
        squared = (floats * floats).sum(axis=1)[:, None] - 2 * (floats @ others.T) + (others * others).sum(axis=1)
        place = squared.argmin(axis=1)
        distance = squared[np.arange(len(place)), place].astype(np.int64)
    else:
        place = np.zeros(len(vectors), np.int64)
        distance = np.full(len(vectors), np.iinfo(np.int64).max)
        for number, centroid in enumerate(some):
            apart = vectors - centroid
            squared = (apart * apart).sum(axis=1)
            closer = squared < distance
            place[closer], distance[closer] = number, squared[closer]
    return candidates[place], distance, len(candidates)


def _kept(vectors: DataFrame, dims: int, id_col: str, vector_col: str) -> DataFrame:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    named = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return named.where((F.size("vector") == dims) & ~F.exists("vector", bad))


def _scaled(column: pa.Array, dims: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(values * SCALE)
    if len(scaled) and np.abs(scaled).max() > LIMIT:
        raise ValueError(f"a component times {SCALE} is beyond ±{LIMIT}; squared distances would not fit into 64 bits")
    return scaled.astype(np.int64).reshape(-1, dims)


def _packed(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a two-dimensional array."""
    width = rows.dtype.itemsize * rows.shape[1]
    data = pa.py_buffer(np.ascontiguousarray(rows).tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, data]).cast(pa.binary())


def _spread(kept: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each scaled component over all vectors; they only decide where the curve is cut."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, dims))
        for batch in batches:
            scaled = _scaled(batch["vector"], dims).astype(np.float64)
            sums += [np.full(dims, len(scaled)), scaled.sum(axis=0), (scaled * scaled).sum(axis=0)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(3 * dims)), pa.array(sums.ravel())], names=["slot", "total"])

    rows = kept.select("vector").transform(mapped, add, "slot long, total double").groupBy("slot").agg(F.sum("total")).collect()
    sums = np.zeros(3 * dims)
    for slot, total in rows:
        sums[slot] = total
    count, first, second = sums.reshape(3, dims)
    mean = first / np.maximum(count, 1)
    deviation = np.sqrt(np.maximum(second / np.maximum(count, 1) - mean * mean, 0))
    return mean, np.where(deviation > 0, deviation, 1.0)


def zone_blocks(kept: DataFrame, dims: int, folder: str) -> DataFrame:
    """The vectors in Hilbert order, one row per block of ``BLOCK`` vectors with its box."""
    mean, deviation = _spread(kept, dims)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scaled = _scaled(batch["vector"], dims)
            cells = np.clip(np.floor((scaled - mean) / deviation) + 2, 0, 3)
            keys = hilbert_keys(cells, BITS)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], _packed(keys), _packed(scaled.astype("<i4")), batch["place"]],
                                             names=["vec_id", "key", "packed", "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                vectors = np.frombuffer(b"".join(part["packed"].to_pylist()), "<i4").reshape(-1, dims)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part["vec_id"].to_pylist()], pa.list_(pa.int64())), pa.array([vectors.tobytes()], pa.binary()),
                    pa.array([vectors.min(axis=0).tobytes()], pa.binary()), pa.array([vectors.max(axis=0).tobytes()], pa.binary()),
                ], names=["ids", "vectors", "low", "high"])

    keys = kept.withColumn("place", F.monotonically_increasing_id()).transform(
        mapped, keyed, "vec_id long, key binary, packed binary, place long")
    ordered = keys.repartitionByRange("key", "place").sortWithinPartitions("key", "place")
    return saved(ordered.transform(mapped, cut, BLOCKS), "zone-blocks", folder, batch_rows=BLOCK)


def _blocks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    for row in range(batch.num_rows):
        whole = lambda name: np.frombuffer(batch[name][row].as_py(), "<i4").astype(np.int64)
        yield batch["ids"][row].values, whole("vectors").reshape(-1, dims), whole("low"), whole("high")


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round; one without vectors stays."""
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            for _, vectors, low, high in _blocks(batch, dims):
                place = nearest(vectors, low, high, centroids)[0]
                order = np.argsort(place, kind="stable")
                found, first = np.unique(place[order], return_index=True)
                totals[found, :dims] += np.add.reduceat(vectors[order], first, axis=0)
                totals[found, dims] += np.diff(np.append(first, len(place)))
        used = np.flatnonzero(totals[:, dims].repeat(dims + 1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals.ravel()[used])], names=["slot", "total"])

    sums = blocks.transform(mapped, add, "slot long, total long")
    totals = np.zeros((k, dims + 1), object)
    with session_conf(blocks.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_BLOCKS)}):
        found = sums.groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect()
    for slot, total in found:
        totals.flat[slot] = int(total)
    moved = centroids.copy()
    for number in range(k):
        if totals[number, dims]:
            moved[number] = [total // totals[number, dims] for total in totals[number, :dims]]
    return moved


def clustered(vectors: DataFrame, k: int, rounds: int, seed: str, dims: int = 64,
              id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and squared distance of each vector that takes part, and the final centroids."""
    spark = vectors.sparkSession
    kept = _kept(vectors, dims, id_col, vector_col)
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = kept.select(F.sha2(named, 256).alias("drawn"), "vector").orderBy("drawn", "vector").limit(k).collect()
    centroids = _scaled(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), dims)
    folder = new_folder(spark, "zone-blocks")
    blocks = zone_blocks(kept, dims, folder) if len(centroids) else spark.createDataFrame([], BLOCKS)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(blocks, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, points, low, high in _blocks(batch, dims):
                place, distance, _ = nearest(points, low, high, centroids)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(place, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    assigned = saved(blocks.transform(mapped, assign, "vec_id long, cluster int, distance long"), "clusters", batch_rows=BATCH_BLOCKS)
    finished(spark)
    if len(centroids):
        dropped(spark, folder)
    return assigned, centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Distances summed per cluster and in all, and each centroid's digest; one small row per cluster is joined."""
    sums = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    text = [",".join(map(str, c)) for c in centroids.tolist()]
    rows = [(i, total, sum(sums.values()), hashlib.sha256(text[i].encode()).hexdigest()) for i, total in sorted(sums.items())]
    per = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_zone_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in 40 clusters after five rounds."""
    from roompulse.llm.storage import table

    return with_inertia(*clustered(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed="2"))


def _sql() -> str:
    """The same in SQL: six assignments in a chain, every vector against every centroid."""
    parts = ["""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v
  FROM kept QUALIFY c < 40
)"""]
    for i in range(6):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT r, c, list_sum(list_transform(list_zip(k.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM kept k, c{i} m) GROUP BY r
)""")
        if i < 5:
            parts.append(f"""s{i} AS (
  SELECT c, p, sum(x) AS total, count(*) AS n
  FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM kept JOIN a{i} USING (r)) GROUP BY c, p
), n{i} AS (
  SELECT c, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY p) AS v FROM s{i} GROUP BY c
), c{i + 1} AS MATERIALIZED (SELECT c, coalesce(n{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN n{i} USING (c))""")
    return "WITH " + ", ".join(parts) + """
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c5.v, ',')) AS centroid_sha256
FROM kept JOIN a5 USING (r) JOIN c5 USING (c)
"""


OP13_SQL = _sql()
