"""Text work inside tasks: word tables and 64-bit hashes over the raw bytes of an Arrow batch.

All functions take whole texts. A *word* is a maximal run of bytes outside ``\\x20`` and
``\\x09``-``\\x0D``, that is ``[^\\x20\\x09-\\x0D]+``. Null texts count as empty. Texts are
worked on in chunks of about ``CHUNK_BYTES`` (one longer text is a chunk by itself), so the
arrays beside a batch stay small.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
CHUNK_TEXTS = 1 << 19
U64 = np.uint64


def byte_set(members: bytes) -> np.ndarray:
    """A 256-entry boolean table of the given bytes."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


SPACE = byte_set(b" \t\n\r\x0b\x0c")
#: Bytes that start a code point (all but UTF-8 continuation bytes).
HEAD = np.array([(b & 0xC0) != 0x80 for b in range(256)])
#: ASCII lower-casing of bytes.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (wrapping arithmetic)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), U64(base))
    out[0] = 1
    return np.cumprod(out, dtype=U64)


class Chunk(NamedTuple):
    """Consecutive texts of a batch: texts ``first`` .. ``first + n``; text i is data[offsets[i]:offsets[i+1]]."""

    first: int
    n: int
    data: np.ndarray
    offsets: np.ndarray


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Split a batch of texts into chunks of about ``size`` bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), len(texts), lo + CHUNK_TEXTS)
        yield Chunk(lo, hi - lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


class Runs(NamedTuple):
    """Runs of a chunk (words, lines): byte range, text number within the chunk."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray


def runs(chunk: Chunk, gap: np.ndarray) -> Runs:
    """Maximal runs of bytes that are not in ``gap``; a run never crosses from one text to the next."""
    inside = ~gap[chunk.data]
    n = len(inside)
    cut = np.zeros(n + 1, bool)
    cut[chunk.offsets] = True
    prev = np.empty(n, bool)
    nxt = np.empty(n, bool)
    if n:
        prev[0], prev[1:] = False, inside[:-1]
        nxt[-1], nxt[:-1] = False, inside[1:]
    start = np.flatnonzero(inside & (~prev | cut[:-1]))
    end = np.flatnonzero(inside & (~nxt | cut[1:])) + 1
    doc = np.searchsorted(chunk.offsets, start, "right") - 1
    return Runs(start, end, doc)


def run_hashes(data: np.ndarray, r: Runs, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of the bytes of every run, the same wherever the run stands."""
    if not len(r.start):
        return np.empty(0, U64)
    length = r.end - r.start
    first = np.concatenate(([0], np.cumsum(length)[:-1]))
    within = np.arange(int(length.sum())) - np.repeat(first, length)
    where = within + np.repeat(r.start, length)
    terms = powers(base, int(length.max()))[within]
    terms *= data[where].astype(U64) + U64(1)
    h = np.add.reduceat(terms, first)
    return mix(h + length.astype(U64) * U64(0xD6E8FEB86659FD93))


def per_text(chunk: Chunk, table: np.ndarray) -> np.ndarray:
    """Per text, the number of its bytes that are in ``table``."""
    total = np.concatenate(([0], np.cumsum(table[chunk.data], dtype=np.int64)))
    return total[chunk.offsets[1:]] - total[chunk.offsets[:-1]]


def windows(h: np.ndarray, doc: np.ndarray, width: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word windows inside each text, and their texts.

    ``doc`` is ascending. With ``short``, a text of 1 to width-1 words is one window by itself.
    The window that starts at word i stands at position i of the word table (see ``window_starts``).
    """
    at = window_starts(doc, width)
    key = np.zeros(len(at), U64)
    for k in range(width):
        key = key * U64(0xD1342543DE82EF95) + h[at + k]
    key, owner = mix(key), doc[at]
    if short and len(doc):
        texts, first, count = np.unique(doc, return_index=True, return_counts=True)
        small = count < width
        texts, first, count = texts[small], first[small], count[small]
        if len(texts):
            extra = np.zeros(len(texts), U64)
            for k in range(width - 1):
                more = count > k
                extra[more] = extra[more] * U64(0xD1342543DE82EF95) + h[first[more] + k]
            key = np.concatenate((key, mix(extra + U64(0x5851F42D4C957F2D) * count.astype(U64))))
            owner = np.concatenate((owner, texts))
            order = np.argsort(owner, kind="stable")
            key, owner = key[order], owner[order]
    return key, owner


def window_starts(doc: np.ndarray, width: int) -> np.ndarray:
    """Word positions at which a window of ``width`` words of one text starts."""
    if len(doc) < width:
        return np.empty(0, np.int64)
    return np.flatnonzero(doc[: len(doc) - width + 1] == doc[width - 1 :])


def text_fingerprints(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's sequence of words (0, 0 for a text without words)."""
    out = []
    count = np.bincount(doc, minlength=n)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    within = np.arange(len(doc)) - first[doc]
    for base in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
        total = np.zeros(n, U64)
        if len(doc):
            terms = mix(h + U64(base & 0xFFFFFFFF)) * powers(base, int(count.max()))[within]
            some = count > 0
            total[some] = np.add.reduceat(terms, first[some])
        out.append(np.where(count > 0, mix(total + count.astype(U64)), U64(0)))
    return out[0], out[1]


def gather(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[begin[i] : begin[i] + size[i]] of all i, one after another."""
    start = np.cumsum(size) - size
    return values[np.arange(int(size.sum())) + np.repeat(begin - start, size)]


class Cache:
    """Rows of values by 64-bit key that a worker computes once, up to ``limit`` keys.

    Past the limit it starts anew, so memory stays bounded and results do not change.
    """

    def __init__(self, limit: int, kind):
        self.limit, self.kind = limit, kind
        self._clear()

    def _clear(self) -> None:
        self.values, self.size = np.empty(0, self.kind), np.empty(0, np.int64)
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []  # sorted keys and their places, large to small

    def _find(self, keys: np.ndarray) -> np.ndarray:
        place = np.full(len(keys), -1, np.int64)
        for known, where in self.tables:
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = known[at] == keys
            place[hit] = where[at[hit]]
        return place

    def _add(self, keys: np.ndarray, where: np.ndarray) -> None:
        """Tables merge while the next one is not much larger, so adding stays cheap."""
        self.tables.append((keys, where))
        while len(self.tables) > 1 and len(self.tables[-2][0]) < 4 * len(self.tables[-1][0]):
            (a, x), (b, y) = self.tables.pop(), self.tables.pop()
            order = np.argsort(both := np.concatenate((a, b)), kind="stable")
            self.tables.append((both[order], np.concatenate((x, y))[order]))

    def rows(self, keys: np.ndarray, make) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and size of the row of each of the sorted, distinct ``keys``, and the values they point into.

        ``make(new)`` gives sizes and flat values for the positions of keys not known yet.
        """
        place = self._find(keys)
        new = np.flatnonzero(place < 0)
        if len(new) and len(self.size) + len(new) > self.limit:
            self._clear()
            place[:], new = -1, np.arange(len(keys))
        if len(new):
            size, values = make(new)
            place[new] = len(self.size) + np.arange(len(new))
            self.size, self.values = np.concatenate((self.size, size)), np.concatenate((self.values, values))
            self._add(keys[new], place[new])
        begin = np.cumsum(self.size) - self.size
        return begin[place], self.size[place], self.values
