"""Suffix-array deduplication: bytes covered by a string of ``LENGTH`` bytes that starts anywhere else too.

Windows (strings of ``LENGTH`` bytes that start at some byte of a text) are the suffixes, read to depth LENGTH.

1. *Sharding.* Every window is named after its anchor, the leftmost of the least-hashed ``GRAM``-byte strings in it:
   equal windows have equal anchors at equal places. Consecutive windows with one anchor are a unit; its key is a hash
   of the bytes that all windows of its kind (the same distance from the anchor, within ``SPAN``) share, so equal
   windows are in units with one key. Units whose key stands alone in the corpus hold no repeated window. Equal units
   (128 bits of hashes) are one member with a count.
2. *Merging.* A member is a shard of a few hundred bytes; aligned at the anchor, its Burrows-Wheeler transform is, column
   for column, the byte before the suffix that starts there. The transforms of all members of a key are merged by
   interleave refinement: the interleave starts as member after member and is refined from the last column to the
   first; a step deals the suffixes stably by the symbol before them, and none is ever sorted anew by its
   content. Where neighbours of the interleave part is their longest common prefix, and the intervals of the
   interleave whose common prefix is LENGTH or more, with a count of two or more, are the repeated windows.
3. A key with more than ``MEMBERS`` different members (a passage between many different neighbours) is split: the
   distances from the anchor are halved, which makes the bytes that all windows share longer, and the parts are grouped
   again, until the groups are small. At distance ranges of one all members are equal, so this always ends.

Defined results: a null or empty text has no bytes, nothing removed, and the hash of nothing. Texts shorter than
LENGTH keep everything. Rows with a null id and repeated rows are documents of their own (copies remove each other).
Texts of any length are taken whole, in pieces of ``PIECE`` bytes. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm import textkit as tk
from driftlog.llm.common import Scratch, cut, ready

LENGTH, GRAM, SPAN = 400, 65, 168
#: Bytes that are worked on at once; members of one key that are merged in one go, and of one task.
PIECE, MEMBERS, PART = 1 << 18, 2_048, 8_192
_PLACE_BITS = 20
_BASE, _OTHER = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_UNIT = "key long, digest long, doc_id long, text_key long, at int, n int, t_lo int"
_MEMBER = "key long, digest long, w long, n int, t_lo int, data binary"


class Hashes:
    """64-bit hashes of the substrings of a piece, from prefix sums: equal bytes give equal hashes wherever they stand."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, base: int):
        most = 1 << max(_PLACE_BITS, len(data).bit_length())
        if (base, most) not in self._powers:
            self._powers[base, most] = tk.powers(base, most), tk.powers(pow(base, -1, 1 << 64), most)
        up, self.down = self._powers[base, most]
        self.sums = np.zeros(len(data) + 1, tk.U64)
        np.cumsum((data.astype(tk.U64) + tk.U64(1)) * up[: len(data)], out=self.sums[1:])

    def all(self, width: int) -> np.ndarray:
        """Of the substrings of ``width`` bytes from every place."""
        return (self.sums[width:] - self.sums[:-width]) * self.down[: len(self.sums) - width]

    def some(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return tk.mix((self.sums[end] - self.sums[start]) * self.down[start])


def anchors(h: Hashes, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """The place of the anchor of every window of a piece."""
    width = length - gram + 1
    low = (h.all(gram) & ~tk.U64((1 << _PLACE_BITS) - 1)) | np.arange(len(h.sums) - gram, dtype=tk.U64)
    have = 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return (low & tk.U64((1 << _PLACE_BITS) - 1)).astype(np.int64)


def _pieces(chunk: tk.Chunk, length: int):
    """(data, offsets, first text, bytes before) in pieces of a bounded size; a piece's windows are in no other piece."""
    if chunk.n > 1 or len(chunk.data) <= PIECE + length:
        yield chunk.data, chunk.offsets, chunk.first, 0
        return
    for lo in range(0, len(chunk.data) - length + 1, PIECE):
        data = chunk.data[lo : lo + PIECE + length - 1]
        yield data, np.array([0, len(data)]), chunk.first, lo


def units(texts: pa.Array, length: int = LENGTH, gram: int = GRAM, span: int = SPAN):
    """Of a batch of texts: text, at (first byte), n windows, t_lo (distance of the last), key, digest; by piece."""
    for chunk in tk.chunks(texts, PIECE):
        for data, offsets, first, before in _pieces(chunk, length):
            if len(data) < length:
                continue
            h = Hashes(data, _BASE)
            place = anchors(h, length, gram)
            start = np.arange(len(place))
            block = (place - start) // span
            name = place * 4096 + block
            doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(place)]
            inside = start + length <= offsets[doc + 1]
            new = np.ones(len(place), bool)
            new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
            at = np.flatnonzero(new)
            n = np.diff(np.concatenate((at, [len(place)])))
            at, n = at[inside[at]], n[inside[at]]
            if not len(at):
                continue
            core = place[at] - block[at] * span
            t_lo = core - (at + n - 1)
            key = tk.mix(h.some(core, core + length - span + 1) + block[at].astype(tk.U64) * tk.U64(_OTHER))
            digest = Hashes(data, _OTHER).some(at, at + n - 1 + length)
            digest = tk.mix(digest + (n * 4096 + t_lo).astype(tk.U64) * tk.U64(_BASE))
            yield doc[at] + first, at - offsets[doc[at]] + before, n, t_lo, key.view(np.int64), digest.view(np.int64)


def _all_units(batches):
    for b in batches:
        text = b.column(2)
        for doc, at, n, t_lo, key, digest in units(text):
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(digest), b.column(0).take(pa.array(doc)), b.column(1).take(pa.array(doc)), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(t_lo.astype(np.int32))],
                ["key", "digest", "doc_id", "text_key", "at", "n", "t_lo"])


def _cut_out(length: int):
    """The bytes of the members that were found in a text."""

    def run(batches):
        for b in batches:
            texts = pc.fill_null(b.column("text").cast(pa.large_binary()), b"")
            for text, found in zip(texts, b.column("found").to_pylist(), strict=True):
                raw = memoryview(text.as_buffer())
                data = [bytes(raw[x["at"] : x["at"] + x["n"] - 1 + length]) for x in found]
                columns = [pa.array([x[c] for x in found], kind) for c, kind in (("key", pa.int64()), ("digest", pa.int64()), ("w", pa.int64()), ("n", pa.int32()), ("t_lo", pa.int32()))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(data, pa.binary())], ["key", "digest", "w", "n", "t_lo", "data"])

    return run


def aligned(data: list[bytes], n: np.ndarray, t_lo: np.ndarray, span: int, length: int) -> np.ndarray:
    """Members as rows of bytes, the windows at distance t from column span - 1 - t on; zeros where a member has no bytes."""
    out = np.zeros((len(data), span - 1 + length), np.uint8)
    shift = (span - t_lo - n).tolist()
    for row, x, at in zip(out, data, shift, strict=True):
        row[at : at + len(x)] = np.frombuffer(x, np.uint8)
    return out


def merged(group: np.ndarray, rows: np.ndarray, n: np.ndarray, t_lo: np.ndarray, w: np.ndarray, span: int, length: int = LENGTH) -> np.ndarray:
    """Which window (by distance) of which member stands twice or more among the members of its group.

    ``group`` ascends. The interleave of the members' transforms is refined symbol by symbol from the right; up to the
    windows at distance 0 in symbols of eight bytes, from there on byte by byte, with a verdict at each distance.
    """
    m, core = len(group), span - 1
    repeated = np.zeros((span, m), bool)
    width = -(-length // 8) * 8
    right = np.zeros((m, width), np.uint8)
    right[:, :length] = rows[:, core : core + length]
    symbols = right.view(">u8")
    first = np.searchsorted(group, group)  # the first member of a member's group
    order = np.arange(m)
    for k in range(symbols.shape[1] - 1, -1, -1):
        s = symbols[:, k]
        if (s != s[first]).any():  # a symbol that is the same for all members of a group deals nothing
            order = order[np.argsort(s[order].astype(tk.U64), kind="stable")]
    order = order[np.argsort(group[order], kind="stable")]
    a, b = order[:-1], order[1:]
    differ = right[a] != right[b]
    prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), length)  # common prefixes of neighbours
    prefix = np.where(group[a] == group[b], prefix, -1)
    part = np.concatenate(([True], group[a] != group[b]))  # where the bytes to the left of column ``core``, or the groups, change
    depth, at_core = np.empty(m, np.int64), order
    t_hi = t_lo + n - 1
    for t in range(span):
        # one number for the members that share the first length - t bytes from column ``core``
        depth[at_core] = np.concatenate(([0], np.cumsum(prefix < length - t)))
        live = (t_lo[order] <= t) & (t <= t_hi[order])
        new = part.copy()
        new[1:] |= depth[order[1:]] != depth[order[:-1]]
        interval = np.cumsum(new) - 1
        total = np.bincount(interval, w[order] * live)
        repeated[t, order] = live & (total[interval] >= 2)
        go_on = t_hi[order] > t  # the others have no byte to the left
        if t + 1 == span or not go_on.any():
            break
        block = np.cumsum(part)[go_on] - 1
        order = order[go_on]
        name = block * 256 + rows[order, core - 1 - t]
        deal = np.argsort(name, kind="stable")
        order, name = order[deal], name[deal]
        part = np.concatenate(([True], name[1:] != name[:-1]))
    return repeated


def _merge_part(span: int, length: int):
    """Runs (lo, hi) of repeated windows, counted from the first window of a member."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, digests = np.asarray(table["key"]), np.asarray(table["digest"])
        order = np.lexsort((digests, keys))
        once = order[np.concatenate(([True], (np.diff(keys[order]) != 0) | (np.diff(digests[order]) != 0)))]
        table = table.take(pa.array(once))  # repeated rows of a document bring a member more than once
        keys, digests, n, t_lo, w = (np.asarray(table[c]) for c in ("key", "digest", "n", "t_lo", "w"))
        n, t_lo = n.astype(np.int64), t_lo.astype(np.int64)
        group = np.cumsum(np.concatenate(([True], keys[1:] != keys[:-1]))) - 1
        found = merged(group, aligned(table["data"].to_pylist(), n, t_lo, span, length), n, t_lo, w, span, length)
        # the first window of a member has the greatest distance
        line = np.zeros((found.shape[1], span + 2), np.int8)
        line[:, 1:-1] = found[::-1].T
        step = np.diff(line, axis=1)
        member, lo = np.nonzero(step == 1)
        hi = np.nonzero(step == -1)[1] - 1
        zero = span - t_lo[member] - n[member]
        return pa.table({"key": pa.array(keys[member]), "digest": pa.array(digests[member]), "lo": pa.array((lo - zero).astype(np.int32)), "hi": pa.array((hi - zero).astype(np.int32))})

    return run


def _halved(span: int, half: int, length: int):
    """Members cut into those windows nearer to the anchor than ``half`` and the others, with keys of their own."""

    def run(batches):
        for b in batches:
            rows = []
            for x in b.to_pylist():
                t_hi = x["t_lo"] + x["n"] - 1
                for base in range(0, span, half):
                    lo, hi = max(x["t_lo"], base), min(t_hi, base + half - 1)
                    if lo > hi:
                        continue
                    core = x["data"][t_hi - base : t_hi - base + length - half + 1]
                    piece = x["data"][t_hi - hi : t_hi - lo + length]
                    name = hashlib.blake2b(core, digest_size=8, key=(x["key"] & (1 << 64) - 1).to_bytes(8, "little") + bytes([base & 255])).digest()
                    mark = hashlib.blake2b(piece, digest_size=8, key=(lo - base).to_bytes(2, "little")).digest()
                    rows.append((x["key"], x["digest"], t_hi - hi, int.from_bytes(name, "little", signed=True), int.from_bytes(mark, "little", signed=True), x["w"], hi - lo + 1, lo - base, piece))
            columns = list(zip(*rows, strict=True)) or [()] * 9
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key0", "digest0", "off", "key", "digest", "w", "n", "t_lo", "data"])

    return run


def repeated_runs(members: DataFrame, span: int = SPAN, length: int = LENGTH, most: int = MEMBERS) -> DataFrame:
    """key, digest, lo, hi: the runs of repeated windows of every member (distinct key and digest)."""
    sizes = members.groupBy("key").agg(F.count("*").alias("_n"))
    large = cut(sizes.where(F.col("_n") > most).select("key"))
    if span > 1 and large.count():
        few = members.join(large, "key", "left_anti")
    else:
        few, large = members, None
    parts = max(1, -(-few.count() // PART))
    few = few.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)))
    runs = few.groupBy("part").applyInArrow(_merge_part(span, length), "key long, digest long, lo int, hi int")
    if large is None:
        return runs
    half = -(-span // 2)
    halves = cut(members.join(large, "key").select("key", "digest", "w", "n", "t_lo", "data").mapInArrow(_halved(span, half, length), f"key0 long, digest0 long, off int, {_MEMBER}"))
    total = halves.groupBy("key", "digest").agg(F.sum("w").alias("w"), F.first("n").alias("n"), F.first("t_lo").alias("t_lo"), F.first("data").alias("data"))
    twice = halves.groupBy("key").agg(F.sum("w").alias("_n")).where("_n > 1").select("key")
    below = cut(repeated_runs(cut(total.join(twice, "key")), half, length, most))
    lifted = halves.select("key0", "digest0", "off", "key", "digest").join(below, ["key", "digest"])
    return runs.unionByName(lifted.select(F.col("key0").alias("key"), F.col("digest0").alias("digest"), (F.col("lo") + F.col("off")).alias("lo"), (F.col("hi") + F.col("off")).alias("hi")))


def _kept(length: int):
    @F.arrow_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def run(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(pc.fill_null(texts.cast(pa.large_binary()), b""), spans.to_pylist(), strict=True):
            raw = memoryview(text.as_buffer())
            rest, done, removed, n = hashlib.sha256(), 0, 0, 0
            for lo, hi in sorted((x["lo"], x["hi"] + length) for x in found or ()):
                if lo > done or not n:  # touching runs are one run
                    rest.update(raw[done:lo])
                    n += 1
                    removed += hi - lo
                else:
                    removed += max(0, hi - done)
                done = max(done, hi)
            rest.update(raw[done:])
            out.append((len(raw), removed, n, rest.hexdigest()))
        n_bytes, n_removed, n_spans, digest = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.StructArray.from_arrays([pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digest, pa.string())], ["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, spans (lo, hi: first and last start of repeated windows) of every text that has any."""
    spark = ready(docs.sparkSession)
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    scratch = Scratch(spark)
    every = scratch.table(docs.mapInArrow(_all_units, _UNIT), "units")
    again = cut(every.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").select("key"))  # by itself, so that Spark can split a hot key's join
    found = scratch.table(every.join(again, "key"), "repeated-units")
    place = F.struct("doc_id", "text_key", "at", "n", "t_lo")
    reps = found.groupBy("key", "digest").agg(F.count("*").alias("w"), F.min(place).alias("p")).select("key", "digest", "w", "p.*")
    by_text = reps.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.collect_list(F.struct("key", "digest", "w", "at", "n", "t_lo")).alias("found"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    members = scratch.table(docs.join(by_text, same).select("text", "found").mapInArrow(_cut_out(LENGTH), _MEMBER).dropDuplicates(["key", "digest"]), "members")
    runs = cut(repeated_runs(members))
    spans = found.join(runs, ["key", "digest"]).select("doc_id", "text_key", F.struct((F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi")).alias("hi")).alias("span"))
    out = cut(spans.groupBy("doc_id", "text_key").agg(F.collect_set("span").alias("spans")))
    scratch.remove()
    return out


def deduplicated(docs: DataFrame) -> DataFrame:
    """Every row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the bytes that stay)."""
    docs = docs.select("doc_id", "text")
    spans = repeated_spans(docs).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "spans")
    rows = docs.withColumn("_text_key", F.xxhash64("text"))
    rows = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left")
    return rows.select("doc_id", _kept(LENGTH)("text", "spans").alias("_k")).select("doc_id", "_k.*")
