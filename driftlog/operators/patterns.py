"""Many needles at once: windows of messages meet needles by hash, in a join.

A needle can only stand in a message as a window of its own length. Each different (tenant, message) is cut into
the windows of the lengths that needles have; their hashes join those of the needles of its tenant and of ``*``,
and what meets is compared in full. No task holds more than a part of the needles, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.session import ship_package

#: Bytes of messages that a worker cuts into windows at once.
PIECE = 1 << 18
#: Characters of needles that are broadcast to the windows, at most; beyond, both sides of the join are shuffled.
MAX_NEEDLE_CHARS = 4 << 20
WILDCARD = "*"
_BASE = 0x9E3779B97F4A7C15


def needle_id(tenant: Column, needle: Column) -> Column:
    """The 64-bit name of a (tenant, folded needle); the join that uses it checks the needle itself again."""
    return F.xxhash64(tenant, needle)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Windows:
    """Hashes of the windows of given lengths (in bytes) of messages: equal bytes have equal hashes wherever they stand."""

    def __init__(self, lengths: list[int]):
        self.lengths = lengths
        most = PIECE + max(lengths, default=0) + 1
        self.up, self.down = _powers(_BASE, most), _powers(pow(_BASE, -1, 1 << 64), most)

    def _groups(self, texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
        rows, group, size = [], [], 0
        for k, text in enumerate(texts):
            if group and size + len(text) > PIECE:
                yield rows, group
                rows, group, size = [], [], 0
            rows.append(k)
            group.append(text)
            size += len(text)
        if group:
            yield rows, group

    def _sums(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        return sums

    def _long(self, text: bytes, n: int) -> np.ndarray:
        """The different hashes of one long text, computed part by part."""
        out = []
        for lo in range(0, len(text) - n + 1, PIECE):
            sums = self._sums(np.frombuffer(text, np.uint8, min(PIECE + n - 1, len(text) - lo), lo))
            out.append((sums[n:] - sums[:-n]) * self.down[: len(sums) - n])
        return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)

    def of(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, hash) of the different windows of each text, a group of texts and a length at a time."""
        for rows, group in self._groups(texts):
            row, is_long = np.array(rows), len(group) == 1 and len(group[0]) > PIECE
            if not is_long:
                size = np.array([len(x) for x in group])
                end, at = np.cumsum(size), np.repeat(np.arange(len(group)), size)  # the text of each byte
                sums = self._sums(np.frombuffer(b"".join(group), np.uint8))
            for n in self.lengths:
                if n == 0:
                    yield row, np.zeros(len(row), np.uint64)
                elif is_long:
                    h = self._long(group[0], n)
                    yield np.repeat(row, len(h)), h
                else:
                    start = np.flatnonzero(np.arange(n, len(at) + n) <= end[at])
                    h, text = (sums[start + n] - sums[start]) * self.down[start], at[start]
                    order = np.lexsort((h, text))
                    h, text = h[order], text[order]
                    new = np.ones(len(h), bool)
                    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                    yield row[text[new]], h[new]


def _cut(lengths: list[int]):
    """The windows of messages (the last column), with the columns before it."""

    def run(batches):
        windows = Windows(lengths)
        for b in batches:
            for row, h in windows.of(b.column("message").cast(pa.binary()).to_pylist()):
                at = pa.array(row)
                kept = [b.column(c).take(at) for c in ("__t", "__k1", "__k2")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(h.view(np.int64))], ["__t", "__k1", "__k2", "__piece"])

    return run


def _window_hashes(lengths: list[int]):
    def run(messages: pa.Array) -> pa.Array:
        texts = messages.cast(pa.binary()).to_pylist()
        found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64)), *Windows(lengths).of([x or b"" for x in texts])]
        row, h = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(row, kind="stable")
        offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(texts)))))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(h[order].view(np.int64)))

    return F.arrow_udf(run, "array<long>")


def _whole_hash():
    def run(needles: pa.Array) -> pa.Array:
        texts = needles.cast(pa.binary()).to_pylist()
        size = np.array([len(x) for x in texts], np.int64)
        out = np.zeros(len(texts), np.uint64)
        for n in np.unique(size[size > 0]).tolist():
            up, rows = _powers(_BASE, n), np.flatnonzero(size == n)
            for some in np.array_split(rows, -(-len(rows) * n // PIECE)):
                data = np.frombuffer(b"".join(texts[k] for k in some), np.uint8).reshape(len(some), n)
                out[some] = ((data.astype(np.uint64) + np.uint64(1)) * up).sum(axis=1, dtype=np.uint64)
        return pa.array(out.view(np.int64))

    return F.arrow_udf(run, "long")


def found_needles(entries: DataFrame, needles: DataFrame, tenant: str, message: str, out: str, carry: Sequence[str] = ()) -> DataFrame:
    """``entries`` with the ids of the needles (id, tenant, needle) of their tenant and of ``*`` in their folded
    message, one row for each. Rows that agree in id, tenant and needle count once; with ``carry`` every row
    of ``needles`` counts and brings these columns. A stream's entries are cut into windows one by one."""
    ship_package(entries.sparkSession)
    needles = needles.where("tenant is not null").select(
        F.col("id").alias(out), F.col("tenant").alias("__n_tenant"), F.coalesce("needle", F.lit("")).alias("__n"), *carry)
    sizes = needles.groupBy(F.octet_length("__n").alias("n")).agg(F.sum(F.length("__n") + F.lit(16)).alias("chars")).collect()  # the lengths that occur
    lengths = sorted(r["n"] for r in sizes)
    needles = (needles if carry else needles.distinct()).withColumn("__n_piece", _whole_hash()("__n"))
    if sum(r["chars"] for r in sizes) <= MAX_NEEDLE_CHARS:
        needles = F.broadcast(needles)
    meets = (F.col("__probe") == F.col("__n_tenant")) & (F.col("__piece") == F.col("__n_piece"))
    holds = F.contains(F.col(message), F.col("__n"))
    probes = lambda c: F.explode(F.array_distinct(F.array(F.col(c), F.lit(WILDCARD))))
    entries = entries.where(F.col(message).isNotNull())
    result = [*entries.columns, out, *carry]
    if entries.isStreaming:
        cut = entries.withColumn("__piece", F.explode(_window_hashes(lengths)(message))).withColumn("__probe", probes(tenant))
        return cut.join(needles, meets & holds, "inner").select(*result)
    # each different (tenant, message) once, named by 128 bits
    keys = [F.xxhash64(message), F.xxhash64(F.lit(1), message)]
    texts = entries.select(F.col(tenant).alias("__t"), keys[0].alias("__k1"), keys[1].alias("__k2"), F.col(message).alias("message")).distinct()
    cut = texts.mapInArrow(_cut(lengths), "__t string, __k1 long, __k2 long, __piece long").withColumn("__probe", probes("__t"))
    found = cut.join(needles, meets, "inner").select("__t", "__k1", "__k2", "__n", out, *carry)
    same = F.col(tenant).eqNullSafe(F.col("__t")) & (keys[0] == F.col("__k1")) & (keys[1] == F.col("__k2")) & holds
    return entries.join(found, same, "inner").select(*result)
