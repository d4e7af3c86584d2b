"""Target-distribution importance resampling over hashed n-grams, with CRCs of substrings from prefixes.

A text is lower-cased (A-Z only) and its words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` are joined by one space.
Each such text is scanned once for its running CRCs; the CRC of any run of words then comes from two of them: the
CRC of a prefix, shifted by the length of the run (a linear map over GF(2)), cancels out of the CRC of the longer
prefix. Features are all runs of 1 to 3 words, repeats counted, in buckets crc32 mod ``BUCKETS``.

The bucket counts of the corpus and of the target texts are summed from one row for each bucket and task; what
reaches the driver is ``BUCKETS`` rows whatever the corpus. The weight of a document is the sum of its features'
gains; a Gumbel draw from a hash of its id is added, and the highest scores are drawn without replacement.

Defined results: a null or empty text has no words, no features and weight 0, and is not drawn. A null id counts as
an empty one in the hash, and comes after the others in ties. Repeated rows are documents of their own; if they tie,
each takes a rank of its own. An empty table gives no rows, an empty target has T = 0. Words of any length and texts
of any length are taken whole. Other columns are ignored.
"""

from __future__ import annotations

from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm import textkit as tk
from driftlog.llm.common import cut, ready

BUCKETS = 10_000
WIDEST = 3
SALT = "42:"
#: Share of the eligible documents that is drawn, and the words a document needs to be eligible.
PERCENT, LEAST_WORDS = 5, 20
POLYNOMIAL = 0xEDB88320  # CRC-32 as zlib has it, bits reversed
_ROW = 256
_ONES = np.uint32(0xFFFFFFFF)
#: Bytes between words: all ASCII but digits and letters; the texts are lower-cased before.
GAP = np.array([b < 128 and not (48 <= b <= 57 or 97 <= b <= 122) for b in range(256)])


def _byte_table() -> np.ndarray:
    """The register after one byte, from the register's low byte xor that byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), t >> np.uint32(1))
    return t


class Shifts:
    """The registers after L zero bytes, for any L: a linear map, kept as tables of the register's four bytes.

    ``tables[p][d]`` is the map for d * 256**p bytes; a length is applied digit by digit.
    """

    def __init__(self):
        self.step = _byte_table()
        self.tables: list[np.ndarray] = []

    def _table(self, place: int) -> np.ndarray:
        while len(self.tables) <= place:
            basis = np.arange(256, dtype=np.uint32)
            out = np.empty((256, 4, 256), np.uint32)
            now = np.stack([basis << np.uint32(8 * k) for k in range(4)])
            for d in range(256):
                out[d] = now
                now = self.step[now & np.uint32(255)] ^ (now >> np.uint32(8)) if not self.tables else self._by(self.tables[-1][255], self._by(self.tables[-1][1], now))
            self.tables.append(out)
        return self.tables[place]

    @staticmethod
    def _by(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        byte = lambda k: (crc >> np.uint32(8 * k)) & np.uint32(255)
        return table[0][byte(0)] ^ table[1][byte(1)] ^ table[2][byte(2)] ^ table[3][byte(3)]

    def same(self, crc: np.ndarray, length: int) -> np.ndarray:
        """Every register shifted by ``length`` bytes."""
        place = 0
        while length:
            crc = self._by(self._table(place)[length & 255], crc)
            length, place = length >> 8, place + 1
        return crc

    def each(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Register i shifted by length[i] bytes."""
        t, digit = self._table(0), length & 255
        byte = lambda x, k: (x >> np.uint32(8 * k)) & np.uint32(255)
        crc = t[digit, 0, byte(crc, 0)] ^ t[digit, 1, byte(crc, 1)] ^ t[digit, 2, byte(crc, 2)] ^ t[digit, 3, byte(crc, 3)]
        far, place = np.flatnonzero(length >> 8), 1
        while len(far):
            t, digit, x = self._table(place), (length[far] >> (8 * place)) & 255, crc[far]
            crc[far] = t[digit, 0, byte(x, 0)] ^ t[digit, 1, byte(x, 1)] ^ t[digit, 2, byte(x, 2)] ^ t[digit, 3, byte(x, 3)]
            place += 1
            far = far[(length[far] >> (8 * place)) > 0]
        return crc


SHIFTS = Shifts()


def prefix_crcs(data: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The CRC register (from zero, not inverted) after data[:p], for each p in ``where``.

    The stream is laid out in rows that are scanned side by side; the registers of whole rows are then summed up
    by doubling steps, and each is shifted on to the places inside the next row.
    """
    rows = max(1, -(-len(data) // _ROW))
    grid = np.zeros((rows, _ROW), np.uint8)
    grid.ravel()[: len(data)] = data
    grid = np.ascontiguousarray(grid.T)
    inside = np.zeros((_ROW + 1, rows), np.uint32)
    step = SHIFTS.step
    for k in range(_ROW):
        r = inside[k]
        inside[k + 1] = step[(r & np.uint32(255)) ^ grid[k]] ^ (r >> np.uint32(8))
    carry = inside[_ROW].copy()  # of a whole row, soon of all rows up to it
    d = 1
    while d < rows:
        carry[d:] ^= SHIFTS.same(carry[:-d], _ROW * d)
        d *= 2
    before = np.concatenate((np.zeros(1, np.uint32), carry))
    row, col = where // _ROW, where % _ROW
    full = row == rows  # the end of the last row
    return np.where(full, before[row], SHIFTS.each(before[row], col) ^ inside[col, np.minimum(row, rows - 1)])


def substring_crcs(at_start: np.ndarray, at_end: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 (as zlib has it) of the substrings between two places, from the registers there."""
    return at_end ^ SHIFTS.each(at_start ^ _ONES, length) ^ _ONES


def feature_buckets(chunk: tk.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every feature of a chunk, and the number of words of every text."""
    lower = chunk._replace(data=tk.LOWER[chunk.data])
    w = tk.runs(lower, GAP)
    words = np.bincount(w.doc, minlength=chunk.n)
    if not len(w.doc):
        return np.empty(0, np.int64), np.empty(0, np.int64), words
    size = w.end - w.start
    begin = np.cumsum(size + 1) - (size + 1)  # in the normalised stream: words with one space behind each
    stream = np.full(int(size.sum()) + len(size), 32, np.uint8)
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    stream[within + np.repeat(begin, size)] = tk.gather(lower.data, w.start, size)
    end = begin + size
    head, tail = np.split(prefix_crcs(stream, np.concatenate((begin, end))), 2)
    buckets, docs = [], []
    for n in range(1, WIDEST + 1):
        first = tk.window_starts(w.doc, n)
        last = first + n - 1
        buckets.append((substring_crcs(head[first], tail[last], end[last] - begin[first]) % np.uint32(BUCKETS)).astype(np.int64))
        docs.append(w.doc[first])
    return np.concatenate(buckets), np.concatenate(docs), words


def bucket_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Features of all texts in each bucket: ``BUCKETS`` numbers, summed from one row for each bucket and task."""

    def count(batches):
        n = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for c in tk.chunks(b.column(0)):
                n += np.bincount(feature_buckets(c)[0], minlength=BUCKETS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["bucket", "n"])

    ready(docs.sparkSession)
    rows = docs.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[np.asarray(rows["bucket"])] = np.asarray(rows["n"])
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What one feature adds to a weight, by bucket: floor(1000 * ln of target share over corpus share), smoothed by one."""
    s_all, t_all = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([floor(1000 * log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in pairs], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_features and weight of the text."""
    held = ready(docs.sparkSession).sparkContext.broadcast(gain)  # 80 KB whatever the corpus

    @F.arrow_udf("n_words long, n_features long, weight long")
    def weigh(x: pa.Array) -> pa.Array:
        parts = [[np.empty(0, np.int64)] for _ in range(3)]
        for c in tk.chunks(x):
            bucket, doc, words = feature_buckets(c)
            order = np.argsort(doc, kind="stable")  # sums of whole numbers: no float in between
            total = np.concatenate(([0], np.cumsum(held.value[bucket[order]])))
            edge = np.concatenate(([0], np.cumsum(count := np.bincount(doc, minlength=c.n))))
            for p, v in zip(parts, (words, count, total[edge[1:]] - total[edge[:-1]]), strict=True):
                p.append(v.astype(np.int64))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(p)) for p in parts], ["n_words", "n_features", "weight"])

    new = ("n_words", "n_features", "weight")
    keep = [c for c in docs.columns if c not in new]
    return docs.select(*keep, weigh(F.col(text)).alias("_weight")).select(*keep, "_weight.*")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, salt: str = SALT) -> DataFrame:
    """Every row of ``docs``: doc_id, n_features, weight, score, rank (from 1 by falling score, null for the undrawn)."""
    docs = docs.select("doc_id", "text")
    gain = gains(bucket_counts(docs), bucket_counts(target))
    name = F.concat(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rows = cut(weighted(docs, gain).select("doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score")))
    enough = F.col("n_words") >= least_words
    # a rank is the place in its range partition, after all partitions before; rows equal in all columns are spread
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "weight", "_row"]
    ordered = rows.where(enough).drop("n_words").withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = cut(ordered.drop("_row")).withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
    counts = sorted((r["_part"], r["n"]) for r in ordered.groupBy("_part").agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for part, n in counts:  # one number for each range partition
        before.append((part, total))
        total += n
    drawn = percent * total // 100
    shift = F.broadcast(docs.sparkSession.createDataFrame(before, "_part int, _before long"))
    ordered = ordered.join(shift, "_part")
    rank = (F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before") + 1).cast("long")
    ranked = ordered.withColumn("rank", F.when(rank <= drawn, rank))
    rest = rows.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank").unionByName(rest.select("doc_id", "n_features", "weight", "score", "rank"))
