"""Dimension-sharded Lloyd clustering in whole numbers.

Vectors are cut into blocks of columns and rows: one row of the block table holds ``ROWS`` vectors' components in
``WIDTH`` columns as a packed matrix. In a round every block's task computes the exact partial squared distances of
its columns to the matching slices of the centroids; the partial distances of the same vectors are added by key
(a shuffle of k numbers for a vector and column block) and the nearest centroid is taken. The labels go back to the
blocks, each of which sums its own columns for each centroid; a task adds up its blocks before the sums are shuffled.
Blocks are checkpointed where they are, partitioned by (row block, column block), so no round moves a component.
The centroids (k x dimensions numbers, whatever the data) pass through the driver.

Components become floor(256 * x); all arithmetic is in 64-bit whole numbers (through doubles where they hold the
products exactly). Vectors are kept if they have exactly ``DIMENSIONS`` components, none null or non-finite; a
component of 2**19 or more in size, whose squared distances would not fit 64 bits, counts as not finite.

Defined results: vectors that are not kept give no row. Rows with a null id are clustered but never start a
centroid. Repeated rows are vectors of their own; equal ids start centroids in the order of their components. With
fewer vectors than k there are fewer centroids. Ties go to the smaller centroid. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.common import cut, ready

CENTROIDS, ROUNDS, DIMENSIONS, SCALE = 40, 5, 64, 256
SALT = "2:"
#: Vectors and columns of one block.
ROWS, WIDTH = 2_048, 16
LARGEST = float(1 << 19)
_BLOCKS = "g long, b int, n int, ids array<long>, data binary"


def whole_vectors(rows: DataFrame, dimensions: int = DIMENSIONS, vector: str = "embedding") -> DataFrame:
    """vec_id and q (whole numbers) of the vectors that are kept."""
    fits = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < LARGEST, F.lit(False)))
    rows = rows.where((F.size(vector) == dimensions) & fits)
    return rows.select("vec_id", F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("int")).alias("q"))


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, salt: str = SALT) -> np.ndarray:
    """The vectors whose salted ids have the smallest hashes, in that order."""
    name = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = vectors.where("vec_id is not null").orderBy(name, "q").limit(k).select("q").collect()
    return np.array([r["q"] for r in rows], np.int64)


def blocks(vectors: DataFrame, width: int = WIDTH, rows: int = ROWS) -> DataFrame:
    """The block table: row block g, column block b, n vectors, their ids (with column block 0), components by column."""

    def pack(batches):
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                piece = batch.slice(lo, rows)
                x = np.asarray(pa.compute.list_flatten(piece.column(1))).astype(np.int32).reshape(piece.num_rows, -1)
                out = [(x[:, at : at + width].T.tobytes(), at // width) for at in range(0, x.shape[1], width)]
                g = (part << 33) + done
                done += 1
                ids = [piece.column(0).to_pylist()] + [None] * (len(out) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * len(out)), pa.array([b for _, b in out], pa.int32()), pa.array([piece.num_rows] * len(out), pa.int32()),
                     pa.array(ids, pa.list_(pa.int64())), pa.array([d for d, _ in out], pa.binary())], ["g", "b", "n", "ids", "data"])

    ready(vectors.sparkSession)
    return cut(vectors.select("vec_id", "q").mapInArrow(pack, _BLOCKS).repartition("g", "b"))


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the columns of x to the rows of c."""
    most = int(np.abs(x).max(initial=0)) + int(np.abs(c).max(initial=0))
    kind = np.float64 if len(x) * most * most < 1 << 52 else np.int64
    a, b = x.astype(kind), c.astype(kind)
    return ((a * a).sum(axis=0)[:, None] - 2 * (a.T @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)


def assign(table: DataFrame, centroids: np.ndarray, width: int = WIDTH) -> DataFrame:
    """Of every row block g: labels (int32) and distances (int64) of its vectors, packed."""
    held = table.sparkSession.sparkContext.broadcast(centroids)  # k x dimensions numbers

    def partial(batches):
        for batch in batches:
            for g, b, n, data in zip(*(batch.column(k).to_pylist() for k in ("g", "b", "n", "data")), strict=True):
                d = _distances(np.frombuffer(data, np.int32).reshape(-1, n), held.value[:, b * width : (b + 1) * width])
                d = d.astype(np.int32) if d.max() < 1 << 31 else d
                yield pa.RecordBatch.from_arrays([pa.array([g]), pa.array([d.itemsize], pa.int32()), pa.array([d.tobytes()], pa.binary())], ["g", "size", "d"])

    def nearest(key: tuple[pa.Scalar, ...], parts: pa.Table) -> pa.Table:
        total = 0
        for size, d in zip(parts["size"].to_pylist(), parts["d"].to_pylist(), strict=True):
            total = total + np.frombuffer(d, f"i{size}").astype(np.int64)
        total = total.reshape(-1, len(held.value))
        label = total.argmin(axis=1)
        least = total[np.arange(len(label)), label]
        return pa.table({"g": pa.array([key[0].as_py()]), "labels": pa.array([label.astype(np.int32).tobytes()], pa.binary()), "distances": pa.array([least.tobytes()], pa.binary())})

    out = table.select("g", "b", "n", "data").mapInArrow(partial, "g long, size int, d binary")
    return cut(out.groupBy("g").applyInArrow(nearest, "g long, labels binary, distances binary"))


def update(table: DataFrame, assigned: DataFrame, centroids: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The next centroids: every column block sums its own columns by label."""
    k, dimensions = centroids.shape
    shards = list(range(-(-dimensions // width)))
    labels = assigned.select("g", "labels", F.explode(F.array(*(F.lit(b) for b in shards))).alias("b"))

    def sums(batches):
        total, count = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for b, n, data, label in zip(*(batch.column(c).to_pylist() for c in ("b", "n", "data", "labels")), strict=True):
                x, label = np.frombuffer(data, np.int32).reshape(-1, n), np.frombuffer(label, np.int32)
                order = np.argsort(label, kind="stable")
                there, first = np.unique(label[order], return_index=True)
                total[there, b * width : b * width + len(x)] += np.add.reduceat(x[:, order].astype(np.int64), first, axis=1).T
                if b == 0:
                    count += np.bincount(label, minlength=k)
        full = np.concatenate((total, count[:, None]), axis=1)
        c, d = np.nonzero(full)
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(d), pa.array(full[c, d])], ["c", "d", "s"])

    joined = table.select("g", "b", "n", "data").join(labels, ["g", "b"])
    rows = joined.mapInArrow(sums, "c long, d long, s long").groupBy("c", "d").agg(F.sum("s").alias("s")).toArrow()
    full = np.zeros((k, dimensions + 1), np.int64)
    full[np.asarray(rows["c"]), np.asarray(rows["d"])] = np.asarray(rows["s"])
    count = full[:, -1:]
    return np.where(count > 0, full[:, :-1] // np.maximum(count, 1), centroids)


def cluster(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, salt: str = SALT, vector: str = "embedding") -> DataFrame:
    """Every kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256."""
    spark = ready(rows.sparkSession)
    vectors = whole_vectors(rows.select("vec_id", vector), dimensions, vector)
    centroids = first_centroids(vectors, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    table = blocks(vectors)
    for _ in range(rounds):
        centroids = update(table, assign(table, centroids), centroids)
    last = assign(table, centroids)

    def unpack(batches):
        for batch in batches:
            for ids, labels, distances in zip(*(batch.column(c).to_pylist() for c in ("ids", "labels", "distances")), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(np.frombuffer(labels, np.int32)), pa.array(np.frombuffer(distances, np.int64))], ["vec_id", "cluster", "distance"])

    named = table.where("b = 0").select("g", "ids").join(last, "g").mapInArrow(unpack, "vec_id long, cluster int, distance long")
    total = F.sum(F.col("distance").cast("decimal(38, 0)"))
    by_cluster = named.groupBy("cluster").agg(total.alias("s")).collect()  # k rows at most
    inertia = sum(int(r["s"]) for r in by_cluster)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame([(r["cluster"], int(r["s"]), inertia, digest[r["cluster"]]) for r in by_cluster], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return named.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
