"""Lloyd's clustering with vectors and centroids cut into blocks of dimensions.

The table of vectors lies as blocks: some rows by some dimensions. In each round a task has a block and the slice of the
centroids with the same dimensions, and gives exact partial distances. Blocks of the same rows are added up by key and
give each row its nearest centroid; those assignments go back to the blocks, and each shard of dimensions makes its own
slice of the new centroids. Numbers are integers throughout, so order and partitioning change nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.llm.staging import materialize

# Components beyond this count as this, so that a squared distance of 64 dimensions fits 64 bits.
LARGEST = 2**27


def quantized(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """Usable vectors with integer components: vec_id, vector."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = rows.filter((F.size("v") == dims) & ~bad)
    inside = lambda x: F.greatest(F.least(F.floor(x), F.lit(LARGEST)), F.lit(-LARGEST))
    bounded = lambda x: F.greatest(F.least(x * scale, F.lit(2.0 * LARGEST)), F.lit(-2.0 * LARGEST))
    return whole.select("vec_id", F.transform("v", lambda x: inside(bounded(x)).cast("long")).alias("vector"))


def first_centroids(rows: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """Vectors with the smallest hashes of seed and id, in that order; ties by content, null ids last."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = rows.orderBy(place.asc_nulls_last(), "vector").select("vector").limit(clusters).collect()
    return np.array([r["vector"] for r in found], np.int64)


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them all."""
    least, most = (int(values.min()), int(values.max())) if values.size else (0, 0)
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= least and most <= np.iinfo(kind).max:
            return values.astype(kind)
    return values


BLOCKS = "chunk long, block int, n int, body binary, width int"


def blocks_of(rows: DataFrame, dims: int, block_dims: int, rows_a_chunk: int) -> tuple[DataFrame, DataFrame]:
    """The vectors as blocks, and the ids of each chunk of rows; both in the shared folder.

    A chunk is up to `rows_a_chunk` rows of one input task, so a vector that is repeated very often is no larger key
    than any other.
    """
    starts = range(0, dims, block_dims)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        ids, parts, waiting = [], [], 0

        def emit() -> pa.RecordBatch:
            nonlocal made
            matrix = np.concatenate(parts)
            bodies = [_narrow(np.ascontiguousarray(matrix[:, s: s + block_dims])) for s in starts]
            chunk = (task << 31) + made
            made += 1
            return pa.record_batch({
                "chunk": pa.array([chunk] * len(bodies), pa.int64()), "block": pa.array(range(len(bodies)), pa.int32()),
                "n": pa.array([len(matrix)] * len(bodies), pa.int32()),
                "body": pa.array([b.tobytes() for b in bodies], pa.binary()),
                "width": pa.array([b.itemsize for b in bodies], pa.int32()),
                "ids": pa.array([[i for column in ids for i in column.to_pylist()]] + [None] * (len(bodies) - 1),
                                pa.list_(pa.int64()))})

        for batch in batches:
            for at in range(0, batch.num_rows, rows_a_chunk):
                piece = batch.slice(at, rows_a_chunk)
                if waiting and waiting + piece.num_rows > rows_a_chunk:
                    yield emit()
                    ids, parts, waiting = [], [], 0
                values = piece.column("vector").flatten().to_numpy(zero_copy_only=False)
                ids.append(piece.column("vec_id"))
                parts.append(values.reshape(-1, dims))
                waiting += piece.num_rows
        if waiting:
            yield emit()

    cuts = materialize(rows.mapInArrow(cut, BLOCKS + ", ids array<long>"))
    return cuts.drop("ids"), cuts.filter("block = 0").select("chunk", "ids")


def _matrix(body: bytes, width: int, n: int) -> np.ndarray:
    return np.frombuffer(body, f"<i{width}").reshape(n, -1)


def _partial(matrix: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances over the dimensions of one block: rows by centroids."""
    out, wide = np.empty((len(matrix), len(centroids)), np.int64), matrix.astype(np.int64)
    for j, centroid in enumerate(centroids):
        apart = wide - centroid
        out[:, j] = np.einsum("ij,ij->i", apart, apart)
    return _narrow(out)


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _narrow(a.astype(np.int64) + b)


def _distances(shards: RDD, slices: list[np.ndarray], tasks: int) -> RDD:
    """(chunk, distances of its rows to all centroids)."""
    parts = shards.map(lambda s: (s[0][0], _partial(_matrix(*s[1]), slices[s[0][1]])))
    return parts.reduceByKey(_add, tasks)


def _next_slices(shards: RDD, slices: list[np.ndarray], tasks: int) -> list[np.ndarray]:
    """One round: nearest centroids, sent back to the blocks, then each shard's slice of the new centroids."""
    blocks, clusters = len(slices), len(slices[0])
    nearest = _distances(shards, slices, tasks).mapValues(lambda d: d.argmin(axis=1).astype(np.min_scalar_type(clusters)))
    back = nearest.flatMap(lambda pair: [((pair[0], b), pair[1]) for b in range(blocks)])

    def sums(pair):
        (_, block), (stored, clusters_of) = pair
        matrix = _matrix(*stored).astype(np.int64)
        total = np.zeros((clusters, matrix.shape[1] + 1), np.int64)
        for j in range(clusters):
            own = matrix[clusters_of == j]
            total[j, :-1], total[j, -1] = own.sum(axis=0), len(own)
        return block, total

    def updated(pair):
        block, total = pair
        counts, old = total[:, -1:], slices[block]
        return block, np.where(counts > 0, total[:, :-1] // np.maximum(counts, 1), old)

    # The blocks already lie by this key and partitioner, so only assignments are shuffled.
    parts = shards.getNumPartitions()
    totals = shards.join(back.partitionBy(parts), parts).map(sums).reduceByKey(np.add, blocks)
    return [s for _, s in sorted(totals.map(updated).collect())]


def cluster(vectors: DataFrame, clusters: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3,
            block_dims: int = 16, rows_a_chunk: int = 16_384, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Clusters of the vectors with `dims` components, none null or non-finite; other vectors are left out.

    A component x becomes floor(scale * x). Centroids start as the `clusters` vectors with the smallest SHA-256 of
    "seed:id", in that order. Each of `rounds` rounds assigns every vector to the nearest centroid by squared distance
    (ties to the smaller number) and replaces every centroid that has vectors by the floor of their mean.

    Returns one row per vector: vec_id, cluster, distance (squared, to the last centroids), cluster_inertia, inertia,
    centroid_sha256 (of the centroid's components as decimal numbers, comma-joined).

    Repeated ids and vectors are rows of their own; null ids are clustered like others but start no centroid while there
    are ids. With fewer vectors than clusters there are that many centroids. Components beyond 2**27 after scaling
    count as 2**27. Other columns are ignored; no usable vectors give no rows.
    """
    found = "vec_id long, cluster int, distance long"
    spark = vectors.sparkSession
    rows = quantized(vectors, dims, scale, id_col, vector_col)
    centroids = first_centroids(rows, clusters, seed)
    if not len(centroids):
        empty = spark.createDataFrame([], found + ", cluster_inertia long, inertia long, centroid_sha256 string")
        return empty
    blocks, ids = blocks_of(rows, dims, block_dims, rows_a_chunk)
    slices = [centroids[:, s: s + block_dims] for s in range(0, dims, block_dims)]
    parts = max(1, min(blocks.count(), 4 * spark.sparkContext.defaultParallelism * len(slices)))
    tasks = max(1, parts // len(slices))
    keyed = blocks.rdd.map(lambda r: ((r["chunk"], r["block"]), (bytes(r["body"]), r["width"], r["n"])))
    shards = keyed.partitionBy(parts).persist()
    try:
        for _ in range(rounds):
            slices = _next_slices(shards, slices, tasks)
        last = _distances(shards, slices, tasks).map(
            lambda pair: (pair[0], [int(c) for c in pair[1].argmin(axis=1)], [int(d) for d in pair[1].min(axis=1)]))
        near = spark.createDataFrame(last, "chunk long, cluster array<int>, distance array<long>")
        zipped = ids.join(near, "chunk").select(F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("r"))
        assigned = materialize(zipped.select(F.col("r.ids").alias("vec_id"), "r.cluster", "r.distance"))
    finally:
        shards.unpersist()
    inertia = {r["cluster"]: r["inertia"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    whole = np.concatenate(slices, axis=1)
    each = [(j, inertia.get(j, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for j, c in enumerate(whole.tolist())]
    facts = spark.createDataFrame(each, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid.
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                                              "centroid_sha256")
