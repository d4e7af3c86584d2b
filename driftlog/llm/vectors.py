"""Embedding near-duplicates by spherical-cap filters.

A filter direction is one code word for each of ``BLOCKS`` blocks of a randomly rotated vector, side by
side (a random product code). A vector belongs to every filter whose direction it exceeds by the cap's
height; because the directions are products, the filters of a vector are list-decoded from the block
scores without trying them all. Vectors that share a filter are compared exactly, in double precision.

The cap is sized from the threshold: among vectors at the threshold similarity a filter of one is a
filter of the other with a probability q that is computed, not guessed, and a vector gets
``ln(1/MISS) / q`` filters on average, so a pair is missed with probability of about ``MISS``; a vector
always gets its ``LEAST`` best filters. The number of filters grows with the number of vectors, which keeps the
expected size of a filter's list the same at every size.

Equal vectors (after normalising) are one point with a count. The members of a filter are dealt in
tiles of ``TILE`` x ``TILE`` points, so one crowded filter spreads over many tasks. Inside a tile no pairs are emitted: a tile gives its points'
link counts and a spanning forest of its links. A pair that shares several filters is counted in the
smallest of them only.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component link with
nothing; so do vectors of different lengths. Rows with a null id count as other vectors and take part in
links; their own id cannot be a component. Repeated rows are vectors of their own: they link with each
other if they are not zero. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, erfc, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.common import cut, ready
from driftlog.llm.components import components

THRESHOLD = 0.95
BLOCKS = 2
MISS = 1e-5
LEAST = 10
#: Vectors in a filter's list, on average.
LIST = 200
TILE = 1_024
#: Crowded filters are broadcast up to this many (24 bytes each), beyond it joined by shuffle.
MAX_BROADCAST = 20_000
SEED = 20


@dataclass(frozen=True)
class Caps:
    """The filters for one length of vectors: ``words`` code words in each block, caps of height ``height``."""

    dim: int
    words: int
    height: float
    seed: int

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """A rotation, and the unit code words of every block."""
        rng = np.random.default_rng((self.seed, self.dim, self.words))
        width = -(-self.dim // BLOCKS)
        rotation, _ = np.linalg.qr(rng.standard_normal((BLOCKS * width, BLOCKS * width)))
        code = rng.standard_normal((BLOCKS, self.words, width))
        return rotation[: self.dim], code / np.linalg.norm(code, axis=2, keepdims=True)


def upper_tail(x: float) -> float:
    """P(a standard normal variable exceeds x)."""
    return 0.5 * erfc(x / sqrt(2))


def cap_height(rate: float, dim: int) -> float:
    """The height that a random unit vector's product with a direction exceeds with probability ``rate``."""
    lo, hi = 0.0, 12.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if upper_tail(mid) > rate else (lo, mid)
    return lo / sqrt(dim)


def stay_probability(height: float, dim: int, cosine: float) -> float:
    """P(a vector at ``cosine`` from another exceeds a filter | the other exceeds it), by quadrature."""
    h = height * sqrt(dim)
    x = h + np.linspace(0, 6, 2001)
    density = np.exp(-(x**2 - h**2) / 2)
    spread = sqrt(max(1 - cosine**2, 1e-12))
    inside = np.array([upper_tail((h - cosine * v) / spread) for v in x])
    return float((density * inside).sum() / density.sum())


def plan_caps(n: int, dim: int, threshold: float = THRESHOLD, seed: int = SEED) -> Caps:
    """Filters for ``n`` vectors of length ``dim``."""
    lists = 16.0  # filters of a vector, to be settled with the cap that gives them
    words, height = 2, 0.0
    for _ in range(20):
        filters = max(256.0, n * lists / LIST)
        words = max(16, ceil(filters ** (1 / BLOCKS)))
        height = cap_height(min(0.25, lists / words**BLOCKS), dim)
        lists = log(1 / MISS) / stay_probability(height, dim, threshold)
    return Caps(dim, words, height, seed)


def decode(x: np.ndarray, caps: Caps) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of all filters that the unit rows of ``x`` exceed, and of each row's ``LEAST`` best.

    Blocks are joined one by one: after each, partial sums that cannot reach the cap even with the
    best words of the blocks to come are dropped.
    """
    rotation, code = caps.codes()
    y = x @ rotation
    width = code.shape[2]
    score = np.stack([y[:, b * width : (b + 1) * width] @ code[b].T for b in range(BLOCKS)]) / sqrt(BLOCKS)
    best = score.max(axis=2)
    # a vector that few directions come near gets a lower cap of its own, which LEAST filters exceed
    top = np.zeros((len(x), 1))
    for b in range(BLOCKS):
        words = -np.partition(-score[b], min(LEAST, caps.words) - 1, axis=1)[:, :LEAST]
        top = (top[:, :, None] + words[:, None, :]).reshape(len(x), -1)
        top = -np.sort(-top, axis=1)[:, :LEAST]
    need = np.minimum(caps.height, top[:, -1] - 1e-12)
    rest = best.sum(axis=0)
    row = np.arange(len(x))
    total, number = np.zeros(len(x)), np.zeros(len(x), np.int64)
    for b in range(BLOCKS):
        rest = rest - best[b]
        parts = []
        for lo in range(0, len(row), 50_000):  # bounded memory: rows x words at a time
            r = row[lo : lo + 50_000]
            sums = total[lo : lo + 50_000, None] + score[b, r]
            at, word = np.nonzero(sums + rest[r, None] >= need[r, None])
            parts.append((r[at], sums[at, word], number[lo : lo + 50_000][at] * caps.words + word))
        row, total, number = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (row, total, number)
    return row, number


def _points(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, point, unit): unit vectors as bytes of doubles, their hash as ``point``; null for unusable ones."""

    @F.arrow_udf("point binary, unit binary")
    def unit(x: pa.Array) -> pa.Array:
        import hashlib

        points, units = [], []
        for v in x:
            v = v.as_py()
            a = np.array(v, float) if v and None not in v else np.empty(0)
            scale = np.abs(a).max() if len(a) and np.isfinite(a).all() else 0.0
            if scale > 0:
                a = a / scale  # first to the largest component, so that squares neither overflow nor vanish
                raw = (a / np.sqrt((a * a).sum()) + 0.0).astype("<f8").tobytes()
                points.append(hashlib.blake2b(raw, digest_size=16).digest())
                units.append(raw)
            else:
                points.append(None)
                units.append(None)
        return pa.StructArray.from_arrays([pa.array(points, pa.binary()), pa.array(units, pa.binary())], ["point", "unit"])

    return vectors.select(F.col(vec_id).alias("vec_id"), unit(F.col(embedding)).alias("_u")).select("vec_id", "_u.*")


def _listed(points: DataFrame, plans: dict[int, Caps]) -> DataFrame:
    """(point, unit, copies, dim, cap, lists): one row for each point and filter; ``lists`` are all of the point's filters."""

    def run(batches):
        for b in batches:
            point, unit, copies = (b.column(k).to_pylist() for k in range(3))
            dims = np.array([len(u) // 8 for u in unit])
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = np.frombuffer(b"".join(unit[k] for k in rows), "<f8").reshape(len(rows), dim)
                row, number = decode(x, plans[int(dim)])
                order = np.lexsort((number, row))
                row, number = row[order], number[order]
                count = np.bincount(row, minlength=len(rows))
                lists = [a.astype("<i8").tobytes() for a in np.split(number, np.cumsum(count)[:-1])]
                for lo in range(0, len(row), 20_000):
                    part = rows[row[lo : lo + 20_000]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([point[k] for k in part], pa.binary()), pa.array([unit[k] for k in part], pa.binary()),
                            pa.array([copies[k] for k in part], pa.int64()), pa.array(np.full(len(part), dim, np.int64)),
                            pa.array(number[lo : lo + 20_000]), pa.array([lists[k] for k in row[lo : lo + 20_000]], pa.binary()),
                        ],
                        ["point", "unit", "copies", "dim", "cap", "lists"],
                    )

    return points.mapInArrow(run, "point binary, unit binary, copies long, dim long, cap long, lists binary")


def _shared_before(lists: list[np.ndarray], cap: int) -> np.ndarray:
    """For every two points of a filter's tile: do they share a smaller filter?"""
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    value = np.concatenate(lists)
    owner, value = owner[value < cap], value[value < cap]
    name, col, count = np.unique(value, return_inverse=True, return_counts=True)
    common = count > 1
    out = np.zeros((len(lists), len(lists)), bool)
    for lo in range(0, len(name), 2048):  # a slice of the filters at a time
        some = common[col] & (col >= lo) & (col < lo + 2048)
        has = np.zeros((len(lists), min(2048, len(name) - lo)), np.float32)
        has[owner[some], col[some] - lo] = 1
        out |= has @ has.T > 0
    return out


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric link matrix, breadth first."""
    todo = linked.any(axis=1)
    edges = []
    while todo.any():
        front = np.flatnonzero(todo)[:1]
        todo[front] = False
        while len(front):
            near = linked[front] & todo
            new = np.flatnonzero(near.any(axis=0))
            edges += zip(front[near[:, new].argmax(axis=0)].tolist(), new.tolist(), strict=True)
            todo[new] = False
            front = new
    return edges


def _compare_tile(threshold: float):
    """Exact comparison of a tile: link counts (a, null, n) and edges of a spanning forest of the links (a, b, 0)."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        side = np.asarray(table.column("side"))
        point, unit = (table.column(k).to_pylist() for k in ("point", "unit"))
        lists = [np.frombuffer(x, "<i8") for x in table.column("lists").to_pylist()]
        copies = np.asarray(table.column("copies"))
        x = np.frombuffer(b"".join(unit), "<f8").reshape(len(unit), -1)
        linked = x @ x.T >= threshold
        across = key[2].as_py() != key[3].as_py()
        linked &= side[:, None] != side[None, :] if across else ~np.eye(len(x), dtype=bool)
        # a pair that shares several filters is counted in the first of them
        n = (linked & ~_shared_before(lists, key[0].as_py())) @ copies if linked.any() else np.zeros(len(x), np.int64)
        rows = [(point[k], None, int(n[k])) for k in np.flatnonzero(n)] + [(point[p], point[q], 0) for p, q in _forest(linked)]
        a, b, c = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "n": pa.array(c, pa.int64())})

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Every row's vec_id, n_links (other vectors linked directly), component_id (smallest vec_id that links
    reach, itself included) and kept (vec_id = component_id)."""
    spark = ready(vectors.sparkSession)
    given = cut(_points(vectors, vec_id, embedding))
    points = cut(given.where("point is not null").groupBy("point").agg(F.first("unit").alias("unit"), F.count("*").alias("copies"), F.min("vec_id").alias("least")))
    sizes = {r["dim"]: r["n"] for r in points.groupBy((F.length("unit") / 8).cast("int").alias("dim")).agg(F.count("*").alias("n")).collect()}
    plans = {dim: plan_caps(n, dim, threshold) for dim, n in sizes.items()}
    listed = _listed(points.select("point", "unit", "copies"), plans)

    # deal each crowded filter's points into groups of TILE by their hash; a pair of groups is a tile
    crowded = cut(listed.groupBy("dim", "cap").agg(F.ceil(F.count("*") / TILE).alias("groups")).where("groups > 1"))
    few = crowded.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    sized = listed.join(F.broadcast(crowded) if few else crowded, ["dim", "cap"], "left").fillna(1, ["groups"])
    sized = sized.withColumn("own", F.pmod(F.xxhash64("point", "cap"), F.col("groups")))
    with_others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1), lambda g: F.struct(
        F.least(g, F.col("own")).alias("i"), F.greatest(g, F.col("own")).alias("j"), F.when(g < F.col("own"), 1).otherwise(0).alias("side")))
    tiles = sized.withColumn("tile", F.explode(with_others)).select("cap", "dim", "tile.i", "tile.j", "tile.side", "point", "unit", "copies", "lists")
    found = cut(tiles.groupBy("cap", "dim", "i", "j").applyInArrow(_compare_tile(threshold), "a binary, b binary, n long"))

    links = found.where("b is null").groupBy(F.col("a").alias("point")).agg(F.sum("n").alias("links"))
    roots = components(found.where("b is not null").select("a", "b"))
    named = points.join(roots.withColumnRenamed("node", "point"), "point", "left").join(links, "point", "left")
    named = named.select("point", F.coalesce("root", "point").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "least")
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(lowest, "root").select("point", "n_links", "component_id")
    out = given.select("vec_id", "point").join(named, "point", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce(F.when(F.col("point").isNotNull(), F.col("component_id")), "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")) & F.col("vec_id").isNotNull())
