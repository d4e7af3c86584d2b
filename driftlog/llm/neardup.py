"""MinHash near-duplicates: improved consistent weighted sampling over TF-IDF shingles.

Shingles are runs of five words (a text of one to four words is one shingle). Words are runs of letters, digits
and non-ASCII characters, with A-Z folded, so a copy in other case or punctuation is a copy; a text of marks alone
has the words between its spaces. A shingle's weight is
its count in the text times ``1 + ln(N/df) / ln(1/RARE)``, cut to [1, 2]: the document frequency is
taken relative to the corpus, so weights mean the same at every size. Frequencies are counted over all
documents in a count-min sketch of fixed size, whose error is about RARE * N documents; anything rarer
weighs the full 2.

1. Texts with equal words are one class. A class's signature is ``BANDS * ROWS`` samples, each equal
   for two texts with the probability of their weighted Jaccard similarity.
2. Classes that agree on a whole band share a bucket. Each is compared with the bucket's smallest
   member on the exact weighted Jaccard similarity of the texts; pairs of ``THRESHOLD`` or more link.
3. Buckets whose members are then still in several components are compared in full, in tiles: first
   the signatures tell which members have a partner in another component that agrees in enough samples
   (4 standard deviations below the threshold), then the texts of those members are compared. A pair
   that shares several buckets belongs to the first. A tile gives the edges of a spanning forest of its
   links, never its pairs, and a bucket that is one component already costs nothing more.
4. Components of the links are the groups; the row of the smallest doc_id stays.

Defined results: null texts, empty texts and texts without words link with nothing and stay. A row
with a null id can be in a group; it stays only if all of the group's ids are null. Of repeated rows
one stays. Very long texts are read whole. An empty table gives no rows. Other columns are ignored by
``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlog.llm import textkit as tk
from driftlog.llm.common import Held, cut, ready
from driftlog.llm.components import components

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
SEED = 4
#: Count-min sketch: two rows of 2**17 counters; shares below RARE weigh alike.
SKETCH_BITS = 17
RARE = 1 / 256
#: Members compared with one leader in one task; signatures, and texts, in one side of a tile.
PER_LEADER, TILE, TEXT_TILE = 512, 1_024, 256
#: Bits of the Bloom filter that keeps texts nobody wants out of the shuffle; 8 MB, whatever the corpus.
BLOOM_BITS, BLOOM_PROBES = 26, 3
#: Bits of one packed segment of it, as tasks build them.
SEGMENT_BITS = 15
#: A shingle is 44 bits of its hash; the rest of the word holds the text's number in its chunk.
_ID_BITS = 44
_ID_MASK = tk.U64((1 << _ID_BITS) - 1)
_SLOTS = 1 << 16
#: Bytes between words: all ASCII but letters and digits.
_MARK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words(c: tk.Chunk) -> tuple[tk.Runs, np.ndarray]:
    """The words of a chunk, folded, and their hashes: runs of letters and digits; of a text without any, what
    stands between spaces."""
    folded = c._replace(data=tk.LOWER[c.data])
    w = tk.runs(folded, _MARK)
    bare = np.bincount(w.doc, minlength=c.n) == 0
    if bare.any():
        rest = tk.runs(folded, tk.SPACE)
        mine = bare[rest.doc]
        merged = [np.concatenate((a, b[mine])) for a, b in zip(w, rest, strict=True)]
        order = np.argsort(merged[0], kind="stable")
        w = tk.Runs(*(x[order] for x in merged))
    return w, tk.run_hashes(folded.data, w)


def shingles(c: tk.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, tk.Runs, np.ndarray]:
    """Distinct shingles of a chunk's texts: (text, shingle, count) in order of both, and the words with their hashes."""
    w, h = words(c)
    key, doc = tk.windows(h, w.doc, WIDTH, short=True)
    both = np.sort((doc.astype(tk.U64) << tk.U64(_ID_BITS)) | (key >> tk.U64(64 - _ID_BITS)))
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.empty(0, np.int64)
    count = np.diff(np.concatenate((first, [len(both)])))
    both = both[first]
    return (both >> tk.U64(_ID_BITS)).astype(np.int64), both & _ID_MASK, count, w, h


def _counters(shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = tk.U64((1 << SKETCH_BITS) - 1)
    return (shingle & mask).astype(np.int64), ((shingle * tk.U64(0x9E3779B97F4A7C15)) >> tk.U64(64 - SKETCH_BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The sketch as ln(N/df) / ln(1/RARE) of each counter, cut to [0, 1]: 2 x 2**SKETCH_BITS floats, whatever the corpus.

    Tasks count in memory and emit each counter once; the sums are a grouped aggregate.
    """

    def run(batches):
        n = np.zeros((2, 1 << SKETCH_BITS), np.int64)
        total = 0
        for b in batches:
            total += b.num_rows
            for c in tk.chunks(b.column(0)):
                for row, at in enumerate(_counters(shingles(c)[1])):
                    n[row] += np.bincount(at, minlength=1 << SKETCH_BITS)
        flat = n.ravel()
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(flat[at], total))], ["counter", "n"])

    ready(docs.sparkSession)
    rows = docs.select(text).mapInArrow(run, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    counter, n = np.asarray(rows["counter"]), np.asarray(rows["n"])
    df = np.ones(2 << SKETCH_BITS)
    df[counter[counter >= 0]] = n[counter >= 0]
    total = max(1, int(n[counter < 0].sum()))
    return np.clip(np.log(total / df) / log(1 / RARE), 0, 1).astype(np.float32).reshape(2, -1)


def weights(shingle: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of shingles."""
    a, b = _counters(shingle)
    return count * (1.0 + np.maximum(idf[0, a], idf[1, b]))


class Sampler:
    """Improved consistent weighted sampling with tabulated Gamma(2, 1) and uniform draws."""

    def __init__(self, samples: int = BANDS * ROWS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.odd = (rng.integers(0, 2**63, samples, np.uint64) << tk.U64(1)) | tk.U64(1)
        self.r = rng.gamma(2.0, 1.0, _SLOTS).astype(np.float32)
        self.c = np.log(rng.gamma(2.0, 1.0, _SLOTS)).astype(np.float32)
        self.beta = rng.random(_SLOTS).astype(np.float32)

    def sample(self, doc_start: np.ndarray, shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The samples (uint32) of the texts whose shingles begin at ``doc_start``."""
        out = np.empty((len(doc_start), len(self.odd)), np.uint32)
        log_w = np.log(weight).astype(np.float32)
        for k, odd in enumerate(self.odd):
            v = (shingle + tk.U64(1)) * odd  # a bijection: both the slot of the draws and the sample's name come from it
            slot = (v >> tk.U64(48)).astype(np.int64)
            r, beta = self.r[slot], self.beta[slot]
            t = np.floor(log_w / r + beta)
            log_a = self.c[slot] - r * (t - beta + np.float32(1))
            bits = log_a.view(np.uint32)
            rank = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31)).astype(tk.U64)  # order of floats as integers
            name = (v ^ (t.astype(np.int64).astype(tk.U64) * tk.U64(0x9E3779B1))) & tk.U64(0xFFFFFFFF)
            out[:, k] = np.minimum.reduceat((rank << tk.U64(32)) | name, doc_start) & tk.U64(0xFFFFFFFF)
        return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of the samples; equal keys only in the same band."""
    keys = np.empty((len(samples), BANDS), np.int64)
    for b in range(BANDS):
        h = np.full(len(samples), tk.U64(b + 1))
        for r in range(ROWS):
            h = tk.mix(h * tk.U64(0xD1342543DE82EF95) + samples[:, b * ROWS + r].astype(tk.U64))
        keys[:, b] = h.view(np.int64)
    return keys


def _signed(texts: pa.Array, idf: np.ndarray, sampler: Sampler) -> pa.StructArray:
    """Class name (16 bytes), samples and band keys of every text; null without words."""
    prints, samples, bands, some = [], [], [], []
    for c in tk.chunks(texts):
        doc, shingle, count, w, h = shingles(c)
        a, b = tk.text_fingerprints(h, w.doc, c.n)
        with_words = np.bincount(w.doc, minlength=c.n) > 0
        some.append(with_words)
        raw = np.stack([a, b], axis=1).astype(">u8").tobytes()
        prints += [raw[16 * k : 16 * k + 16] if x else None for k, x in enumerate(with_words)]
        if not len(doc):
            samples += [None] * c.n
            continue
        start = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        got = sampler.sample(start, shingle, weights(shingle, count, idf))
        raw = got.astype("<u4").tobytes()
        size = 4 * got.shape[1]
        place = np.cumsum(with_words) - 1
        samples += [raw[size * p : size * p + size] if x else None for p, x in zip(place.tolist(), with_words.tolist(), strict=True)]
        bands.append(band_keys(got))
    there = np.concatenate(some) if some else np.empty(0, bool)
    flat = np.concatenate(bands).ravel() if bands else np.empty(0, np.int64)
    offsets = np.concatenate(([0], np.cumsum(there * BANDS))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
    return pa.StructArray.from_arrays([pa.array(prints, pa.binary()), pa.array(samples, pa.binary()), lists], ["fp", "samples", "bands"])


def signed(docs: DataFrame, idf, text: str = "text") -> DataFrame:
    """doc_id, text_key (hash of the text), fp (class name), samples, bands of every row."""
    samplers: list[Sampler] = []

    @F.arrow_udf("fp binary, samples binary, bands array<long>")
    def sign(x: pa.Array) -> pa.Array:
        if not samplers:
            samplers.append(Sampler())
        return _signed(x, idf.value, samplers[0])

    return docs.select("doc_id", F.xxhash64(text).alias("text_key"), sign(F.col(text)).alias("_s")).select("doc_id", "text_key", "_s.*")


def _similar(a, b, threshold: float) -> bool:
    """Is the weighted Jaccard similarity of (shingles, weights, total) a and b the threshold or more?"""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    if min(a[2], b[2]) < threshold * max(a[2], b[2]):
        return False
    place = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    hit = b[0][place] == a[0]
    least = np.minimum(a[1][hit], b[1][place[hit]]).sum()
    return bool(least >= threshold * (a[2] + b[2] - least))


def _described(texts: pa.Array, idf: np.ndarray) -> list:
    """(shingles, weights, total weight) of each text."""
    out = []
    for c in tk.chunks(texts):
        doc, shingle, count, _, _ = shingles(c)
        weight = weights(shingle, count, idf)
        edge = np.searchsorted(doc, np.arange(c.n + 1))
        out += [(shingle[i:j], weight[i:j], float(weight[i:j].sum())) for i, j in zip(edge[:-1], edge[1:], strict=True)]
    return out


def _once(table: pa.Table) -> pa.Table:
    """One row for each class: repeated rows of ``documents`` bring a text more than once."""
    _, first = np.unique(np.array(table.column("fp").to_pylist(), "S16"), return_index=True)
    return table.take(pa.array(np.sort(first)))


def _edges(pairs: list) -> pa.Table:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _with_leader(idf, threshold: float):
    """Links of a leader with the members of its group."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = _once(table)
        leads = np.asarray(table.column("leads"))
        names = table.column("fp").to_pylist()
        sets = _described(table.column("text").combine_chunks(), idf.value)
        at = int(np.flatnonzero(leads)[0])
        return _edges([(names[at], names[k]) for k in range(len(names)) if k != at and _similar(sets[at], sets[k], threshold)])

    return run


def _packed_segment(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The set bits of one segment of the Bloom filter, packed."""
    bits = np.zeros(1 << SEGMENT_BITS, bool)
    bits[np.asarray(table["spot"]) & ((1 << SEGMENT_BITS) - 1)] = True
    return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def _texts(wanted: DataFrame, docs: DataFrame, hold: Held) -> DataFrame:
    """``wanted`` (with _id and _key of a row) with the row's text. A Bloom filter of bounded size keeps other
    texts out of the shuffle; past its size it lets more of them in, and the join still drops them."""
    key = F.xxhash64("_id", "_key")
    spots = F.explode(F.array(*(F.pmod(F.xxhash64(key, F.lit(k)), F.lit(1 << BLOOM_BITS)) for k in range(BLOOM_PROBES))))
    spots = wanted.select("_id", "_key").distinct().select(spots.alias("spot")).distinct()
    packed = spots.groupBy(F.shiftright("spot", SEGMENT_BITS).alias("segment")).applyInArrow(_packed_segment, "segment long, bits binary").toArrow()
    bloom = np.zeros((1 << (BLOOM_BITS - SEGMENT_BITS), (1 << SEGMENT_BITS) // 8), np.uint8)
    for segment, bits in zip(packed["segment"].to_pylist(), packed["bits"], strict=True):
        bloom[segment] = np.frombuffer(bits.as_buffer(), np.uint8)
    held = hold.broadcast(bloom.ravel())

    @F.arrow_udf("boolean")
    def maybe(*spots: pa.Array) -> pa.Array:
        hit = np.ones(len(spots[0]), bool)
        for x in spots:
            x = np.asarray(x)
            hit &= (held.value[x >> 3] >> (x & 7).astype(np.uint8)) & 1 == 1
        return pa.array(hit)

    own = F.xxhash64("doc_id", "text_key")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    rows = rows.where(maybe(*(F.pmod(F.xxhash64(own, F.lit(k)), F.lit(1 << BLOOM_BITS)) for k in range(BLOOM_PROBES))))
    return rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))).drop("doc_id", "text_key", "_id", "_key")


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, idf, hold: Held, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) of class names whose texts are similar enough. A leader's members are dealt to groups of
    about PER_LEADER; texts travel once for each group that needs them."""
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / PER_LEADER).alias("groups"))
    members = pairs.join(groups, "a").select(F.col("b").alias("fp"), F.col("a").alias("leader"), F.pmod(F.xxhash64("b"), F.col("groups")).alias("part"), F.lit(False).alias("leads"))
    leaders = groups.select(F.col("a").alias("fp"), F.col("a").alias("leader"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("part"), F.lit(True).alias("leads"))
    where = classes.select("fp", F.col("lead.doc_id").alias("_id"), F.col("lead.text_key").alias("_key"))
    wanted = cut(members.unionByName(leaders).join(where, "fp"))
    return _texts(wanted, docs, hold).groupBy("leader", "part").applyInArrow(_with_leader(idf, threshold), "a binary, b binary")


def _partners(x: np.ndarray, side: np.ndarray, root: np.ndarray, across: bool, band: int, least: int):
    """For each member i of a tile's first side: (i, partners): in another component, agreeing in ``least``
    samples or more, and on this band before any other; those that agree most first."""
    for i in np.flatnonzero(side == 0):
        j = np.flatnonzero(side == 1) if across else np.arange(i + 1, len(x))
        j = j[root[j] != root[i]]
        same = x[j] == x[i]
        agree = same.sum(axis=1)
        keep = (agree >= least) & (same.reshape(len(j), BANDS, ROWS).all(axis=2).argmax(axis=1) == band)
        yield i, j[keep][np.argsort(-agree[keep], kind="stable")]


def _tile_columns(key: tuple[pa.Scalar, ...], table: pa.Table):
    roots = table.column("root").to_pylist()
    number = {r: k for k, r in enumerate(sorted(set(roots)))}
    x = np.frombuffer(b"".join(table.column("samples").to_pylist()), "<u4").reshape(table.num_rows, -1)
    return x, np.asarray(table.column("side")), np.array([number[r] for r in roots]), key[2].as_py() != key[3].as_py(), key[1].as_py()


def _flag_tile(least: int):
    """The members of a tile that have a partner."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        flag = np.zeros(table.num_rows, bool)
        for i, j in _partners(*_tile_columns(key, table), least):
            flag[j] = True
            flag[i] |= len(j) > 0
        names = table.column("fp").take(pa.array(np.flatnonzero(flag)))
        return pa.table({"band": pa.array([key[0].as_py()] * len(names), pa.int64()), "fp": names.cast(pa.binary())})

    return run


def _text_tile(idf, threshold: float, least: int):
    """Edges of a spanning forest of the links between components in a tile."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        # a member is on one side of a tile only, so one row for each class is one for each member
        table = _once(table)
        columns = _tile_columns(key, table)
        names = table.column("fp").to_pylist()
        sets = _described(table.column("text").combine_chunks(), idf.value)
        top = np.arange(int(columns[2].max()) + 1)  # the members' components, joined as links are found

        def find(k: int) -> int:
            while top[k] != k:
                top[k] = top[top[k]]
                k = top[k]
            return k

        edges = []
        for i, partners in _partners(*columns, least):
            for j in partners.tolist():
                p, q = find(columns[2][i]), find(columns[2][j])
                if p != q and _similar(sets[i], sets[j], threshold):
                    top[p] = q
                    edges.append((names[i], names[j]))
        return _edges(edges)

    return run


def _tiled(rows: DataFrame, size: int) -> DataFrame:
    """Members of buckets dealt to pairs of groups of about ``size``: band, b, i, j, side and the other columns."""
    groups = rows.groupBy("band").agg(F.ceil(F.count("*") / size).alias("groups"))
    rows = rows.join(groups, "band").withColumn("own", F.pmod(F.xxhash64("fp", "band"), F.col("groups")))
    others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1), lambda g: F.struct(
        F.least(g, F.col("own")).alias("i"), F.greatest(g, F.col("own")).alias("j"), F.when(g < F.col("own"), 1).otherwise(0).alias("side")))
    return rows.withColumn("tile", F.explode(others)).drop("own", "groups").select("*", "tile.*").drop("tile")


def _left_over(classes: DataFrame, buckets: DataFrame, roots: DataFrame, docs: DataFrame, idf, hold: Held, threshold: float) -> DataFrame:
    """Links (a, b) in buckets that still hold several components."""
    samples = BANDS * ROWS
    least = int(samples * threshold - 4 * sqrt(samples * threshold * (1 - threshold)))
    rows = buckets.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    mixed = rows.groupBy("band").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).where("_lo <> _hi").select("band")
    rows = cut(rows.join(mixed, "band").join(classes.select("fp", "samples"), "fp"))
    tile = ["band", "b", "i", "j"]
    flagged = _tiled(rows, TILE).groupBy(tile).applyInArrow(_flag_tile(least), "band long, fp binary").distinct()
    where = classes.select("fp", F.col("lead.doc_id").alias("_id"), F.col("lead.text_key").alias("_key"))
    wanted = cut(_tiled(rows.join(flagged, ["band", "fp"]), TEXT_TILE).join(where, "fp"))
    return _texts(wanted, docs, hold).groupBy(tile).applyInArrow(_text_tile(idf, threshold, least), "a binary, b binary")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every row: doc_id, text_key, cluster_id (smallest doc_id of its group), cluster_size (rows), kept."""
    docs = docs.select("doc_id", "text")
    spark = ready(docs.sparkSession)
    hold = Held(spark)
    idf = hold.broadcast(document_frequencies(docs))  # 1 MB
    rows = cut(signed(docs, idf))
    lead = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = cut(rows.where("fp is not null").groupBy("fp").agg(F.min(lead).alias("lead"), F.first("samples").alias("samples"), F.first("bands").alias("bands"), F.count("*").alias("n")))

    members = classes.select("fp", F.posexplode("bands").alias("b", "band"))
    shared = members.groupBy("band").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("band", "a")
    buckets = cut(members.join(shared, "band"))
    pairs = buckets.where("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    links = cut(verify(pairs, classes, docs, idf, hold, threshold))
    roots = cut(components(links))
    more = cut(_left_over(classes, buckets.select("band", "b", "fp"), roots, docs, idf, hold, threshold))
    hold.release()  # all that follows reads checkpoints
    roots = cut(components(links.unionByName(more)))

    named = classes.select("fp", "lead", "n").join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = named.groupBy("root").agg(F.min("lead").alias("best"), F.sum("n").alias("cluster_size"))
    named = named.join(best, "root").select("fp", "best", "cluster_size")
    out = rows.select("doc_id", "text_key", "fp").join(named, "fp", "left")
    own = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_key") == F.col("best.text_key"))
    return out.select(
        "doc_id", "text_key", F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("cluster_id"),
        F.coalesce("cluster_size", F.lit(1)).cast("long").alias("cluster_size"), (F.col("fp").isNull() | own).alias("kept"),
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without near-duplicates: one row of each group, with all its columns."""
    keep = near_duplicates(docs, threshold).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "cluster_size").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.xxhash64("text").alias("_text_key"))
    rows = rows.join(keep.select("_id", "_key"), F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")))
    alike = Window.partitionBy("_id", "_text_key").orderBy(F.lit(0))
    # repeated rows of a kept text: one stays, unless the text has no words and so no group
    rows = rows.withColumn("_nth", F.row_number().over(alike))
    rows = rows.where((F.col("_nth") == 1) | ~F.rlike(F.coalesce("_row.text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]")))
    return rows.select(*(F.col("_row")[c].alias(c) for c in docs.columns))
