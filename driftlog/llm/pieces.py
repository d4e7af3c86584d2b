"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

Texts are cut where no piece of the vocabulary can reach across, equal segments are encoded once, and
all segments of one length advance together: at every end position the hashes of the substrings that
end there probe the sorted keys of the pieces, and a vectorised maximum over the piece lengths stores
the best piece as backpointer.

For a unigram model a path's score is the sum of its pieces' scores. The public model file is a BPE
model: there the sum of scores is not what the model means (it is a merge rank). Its segmentation is
the one path on which every two neighbouring pieces are what the merges would make of the two joined:
merges inside a stretch that no merge crosses are the same as if the stretch stood alone, so a path
that agrees pair by pair agrees as a whole, and there is exactly one. The search therefore lets a
piece follow another only if the pair is *stable* (``Vocabulary.stable``) and gives the ids of the
library's own encoder.

Defined results: null and empty texts have no ids and decode to ''. White space is kept as it is (the
model's normaliser is the identity with a leading space), characters outside the vocabulary become
byte pieces, so decoding an encoded text gives the text back. Texts of any length are read whole.
Repeated rows get equal ids; other columns pass through, those named like an output are replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm import textkit as tk
from driftlog.llm.common import ready

MODEL = "piece_bpe_32k.model"
SPACE = 0x2581
#: Distinct segments whose ids a worker keeps between batches, and pairs whose stability it keeps.
CACHE_SEGMENTS, CACHE_PAIRS = 600_000, 600_000
_BASE = tk.U64(0x9E3779B97F4A7C15)
_NEVER, _ALWAYS = -np.inf, np.inf


class Vocabulary:
    """Pieces, their hash keys, and the merges inside each piece. Built once on the driver; a few MB for 32,000 pieces."""

    def __init__(self, model: str = MODEL, bpe: bool = True):
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        is_byte = [sp.is_byte(i) for i in range(n)]
        text = [sp.id_to_piece(i) for i in range(n)]
        self.bpe, self.size = bpe, n
        self.score = np.array([sp.get_score(i) for i in range(n)])
        self.byte_id = np.zeros(256, np.int32)
        plain: dict[str, int] = {}
        for i in range(n):
            if is_byte[i]:
                self.byte_id[int(text[i][1:-1], 16)] = i
            elif not special[i]:
                plain[text[i]] = i
        # what each id decodes to
        raw = [bytes([int(t[1:-1], 16)]) if b else b"" if s else t.replace(chr(SPACE), " ").encode() for t, b, s in zip(text, is_byte, special, strict=True)]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(r) for r in raw], np.int64)
        self.raw_begin = np.cumsum(self.raw_size) - self.raw_size
        # characters of the vocabulary, numbered from 1; 0 is any other
        chars = sorted({c for t in plain for c in t})
        self.char = np.zeros(0x110000, np.int16 if len(chars) < 2**15 - 1 else np.int32)
        self.char[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        number = {c: k for k, c in enumerate(chars, 1)}
        self.joins = np.zeros((len(chars) + 1, len(chars) + 1), bool)  # can two characters stand side by side in a piece
        for t in plain:
            for a, b in zip(t, t[1:], strict=False):
                self.joins[number[a], number[b]] = True
        self.single = np.full(len(chars) + 1, -1, np.int32)
        for t, i in plain.items():
            if len(t) == 1:
                self.single[number[t]] = i
        if bpe:
            self._merges(plain)
        usable = [(t, i) for t, i in plain.items() if not bpe or self.whole[i]]
        self.longest = max((len(t) for t, _ in usable), default=1)
        keys = np.array([self._key(t, number) for t, _ in usable], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array([i for _, i in usable], np.int64)[order]

    @staticmethod
    def _key(t: str, number: dict[str, int]) -> int:
        h = 0
        for c in t:
            h = (h * int(_BASE) + number[c] + 1) & (2**64 - 1)
        return h

    def _merges(self, plain: dict[str, int]) -> None:
        """Run the merges on every piece by itself: which pieces they make at all, and from which two parts."""
        rank = {t: -self.score[i] for t, i in plain.items()}
        left, right = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64)
        self.whole = np.zeros(self.size, bool)
        for t, i in plain.items():
            parts = list(t)
            last = None
            while len(parts) > 1:
                best = min(((rank.get(a + b, np.inf), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))), default=(np.inf, 0))
                if best[0] == np.inf:
                    break
                k = best[1]
                last = (parts[k], parts[k + 1])
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            self.whole[i] = len(parts) == 1
            if len(parts) == 1 and last:
                left[i], right[i] = plain.get(last[0], -1), plain.get(last[1], -1)
        # every way to part a piece in two pieces: what a merge across a border could make
        pairs = sorted({(plain[t[:k]] * self.size + plain[t[k:]], i) for t, i in plain.items() for k in range(1, len(t)) if t[:k] in plain and t[k:] in plain})
        self.pair_key = np.array([p for p, _ in pairs], np.int64)
        self.pair_score = self.score[[i for _, i in pairs]] if pairs else np.empty(0)
        birth = np.where(left >= 0, self.score, _ALWAYS)
        self.edge = {}
        for name, child in (("left", left), ("right", right)):
            # the pieces at this edge of each piece while its merges run: (piece, its birth, its death)
            part, death, owner = [np.arange(self.size)], [np.full(self.size, _NEVER)], [np.arange(self.size)]
            while len(part[-1]):
                inner = child[part[-1]]
                some = inner >= 0
                death.append(self.score[part[-1]][some])
                owner.append(owner[-1][some])
                part.append(inner[some])
            order = np.argsort(np.concatenate(owner), kind="stable")
            size = np.bincount(np.concatenate(owner), minlength=self.size)
            part = np.concatenate(part)[order]
            self.edge[name] = (np.cumsum(size) - size, size, part, birth[part], np.concatenate(death)[order])

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Would the merges leave piece ``a`` followed by piece ``b`` as these two?

        A merge across the border joins a part x at a's right edge with a part y at b's left edge. It
        comes about once both are there, if by then neither has been merged away: later than its own
        score and both births, before x's death (a tie goes to the merge further left, which is x's),
        and not after y's.
        """
        rb, rs, rp, r_birth, r_death = self.edge["right"]
        lb, ls, lp, l_birth, l_death = self.edge["left"]
        n = rs[a] * ls[b]
        pair = np.repeat(np.arange(len(a)), n)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        width = ls[b][pair]
        x, y = rb[a][pair] + k // width, lb[b][pair] + k % width
        key = rp[x] * self.size + lp[y]
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        hit = self.pair_key[at] == key if len(self.pair_key) else np.zeros(len(key), bool)
        pair, x, y, at = pair[hit], x[hit], y[hit], at[hit]
        when = np.minimum(self.pair_score[at], np.minimum(r_birth[x], l_birth[y]))
        crossed = (when > r_death[x]) & (when >= l_death[y])
        out = np.ones(len(a), bool)
        out[pair[crossed]] = False
        return out


class Encoder:
    """Encodes batches of texts with one vocabulary."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.segments = tk.Cache(CACHE_SEGMENTS, np.int32)
        self.pairs = tk.Cache(CACHE_PAIRS, bool)

    def _stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key, back = np.unique(a * self.v.size + b, return_inverse=True)

        def check(new):
            k = key[new]
            return np.ones(len(k), np.int64), self.v.stable(k // self.v.size, k % self.v.size)

        begin, _, values = self.pairs.rows(key, check)
        return values[begin][back]

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of pieces and ids (row by row) of segments of one length, a row of character numbers each."""
        v = self.v
        n, length = codes.shape
        prefix = np.zeros((n, length + 1), tk.U64)
        for i in range(length):
            prefix[:, i + 1] = prefix[:, i] * _BASE + codes[:, i].astype(tk.U64) + tk.U64(1)
        power = tk.powers(int(_BASE), length + 1)
        best = np.full((n, length + 1), _NEVER)
        best[:, 0] = 0.0
        piece = np.full((n, length + 1), -1, np.int64)
        step = np.zeros((n, length + 1), np.int64)
        for i in range(1, length + 1):
            for size in range(min(i, v.longest), 0, -1):
                j = i - size
                key = prefix[:, i] - prefix[:, j] * power[size]
                at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
                row = np.flatnonzero((v.keys[at] == key) & (best[:, j] > _NEVER))
                if v.bpe:
                    row = row[best[row, i] == _NEVER]  # one stable path only
                ids = v.ids[at[row]]
                if v.bpe and j and len(row):
                    ok = self._stable(piece[row, j], ids)
                    row, ids = row[ok], ids[ok]
                total = best[row, j] + v.score[ids]
                more = total > best[row, i]
                row, ids = row[more], ids[more]
                best[row, i], piece[row, i], step[row, i] = total[more], ids, size
        count = np.zeros(n, np.int64)
        out = np.empty((n, length), np.int32)
        at = np.full(n, length)
        live = np.flatnonzero(at > 0)
        while len(live):
            out[live, length - 1 - count[live]] = piece[live, at[live]]
            count[live] += 1
            at[live] -= step[live, at[live]]
            live = live[at[live] > 0]
        flat = out[np.arange(length)[None, :] >= (length - count)[:, None]]
        return count, flat

    def _new(self, points: np.ndarray, codes: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Sizes and ids of distinct segments."""
        length = end - start
        size = np.zeros(len(start), np.int64)
        flats, places = [], []
        for n in np.unique(length):
            rows = np.flatnonzero(length == n)
            if n == 1:
                known = self.v.single[codes[start[rows]]]
                for k in np.flatnonzero(known < 0):  # characters outside the vocabulary: byte pieces
                    raw = np.frombuffer(chr(points[start[rows[k]]]).encode("utf-8", "replace"), np.uint8)
                    size[rows[k]] = len(raw)
                    places.append(rows[k : k + 1])
                    flats.append(self.v.byte_id[raw])
                one = rows[known >= 0]
                size[one] = 1
                places.append(one)
                flats.append(known[known >= 0])
                continue
            most = max(1, 1_000_000 // int(n))  # rows of one search: bounded memory
            for lo in range(0, len(rows), most):
                some = rows[lo : lo + most]
                count, flat = self.viterbi(codes[start[some][:, None] + np.arange(n)])
                size[some] = count
                places.append(some)
                flats.append(flat)
        place, flat = np.concatenate(places), np.concatenate(flats).astype(np.int32)
        held = size[place]
        begin = np.empty(len(size), np.int64)
        begin[place] = np.cumsum(held) - held
        return size, tk.gather(flat, begin, size)

    def encode(self, c: tk.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk's texts one after another, and the number of ids of each."""
        size = c.offsets[1:] - c.offsets[:-1]
        heads = np.concatenate(([0], np.cumsum(tk.HEAD[c.data], dtype=np.int64)))
        lengths = heads[c.offsets[1:]] - heads[c.offsets[:-1]]
        lengths = np.where(size > 0, lengths + 1, 0)  # a space before every text that is not empty
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        points = np.full(int(offsets[-1]), SPACE, np.uint32)
        inner = np.ones(len(points), bool)
        inner[offsets[:-1][size > 0]] = False
        text = np.frombuffer(c.data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
        points[inner] = text
        points[points == 32] = SPACE
        if not len(points):
            return np.empty(0, np.int32), np.zeros(c.n, np.int64)
        codes = self.v.char[points]
        cut = np.ones(len(points) + 1, bool)
        cut[1:-1] = ~self.v.joins[codes[:-1], codes[1:]]
        cut[offsets] = True
        edge = np.flatnonzero(cut)
        start, end = edge[:-1], edge[1:]
        doc = np.searchsorted(offsets, start, "right") - 1
        keys, first, back = np.unique(tk.run_hashes(points, tk.Runs(start, end, doc)), return_index=True, return_inverse=True)
        begin, held, ids = self.segments.rows(keys, lambda new: self._new(points, codes, start[first[new]], end[first[new]]))
        held = held[back]
        return tk.gather(ids, begin[back], held), np.bincount(doc, held, minlength=c.n).astype(np.int64)


def encode_batch(texts: pa.Array, encoder: Encoder) -> pa.Array:
    """list<int> ids of a batch of texts."""
    parts = [encoder.encode(c) for c in tk.chunks(texts)]
    count = np.concatenate([n for _, n in parts]) if parts else np.empty(0, np.int64)
    flat = np.concatenate([x for x, _ in parts]) if parts else np.empty(0, np.int32)
    offsets = np.concatenate(([0], np.cumsum(count)))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))


#: Ids that are turned into bytes at a time.
DECODE_IDS = 400_000


def raw_bytes(ids: np.ndarray, count: np.ndarray, v: Vocabulary):
    """The bytes of each of consecutive id lists, the leading space left out; ids outside the vocabulary add none."""
    ends = np.cumsum(count)
    lo = 0
    while lo < len(count):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + DECODE_IDS, "right")))
        values = ids[done : ends[hi - 1]]
        known = (values >= 0) & (values < v.size)
        values = np.where(known, values, 0)
        size = np.where(known, v.raw_size[values], 0)
        data = tk.gather(v.raw, v.raw_begin[values], size).tobytes()
        edge = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], ends[lo:hi] - done))].tolist()
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            yield data[a + 1 : b] if data[a : a + 1] == b" " and b > a else data[a:b]
        lo = hi


def decode_batch(ids: pa.Array, v: Vocabulary) -> pa.Array:
    """Texts of a batch of id lists; null ids and ids outside the vocabulary add nothing, damaged byte runs become U+FFFD."""
    if isinstance(ids, pa.ChunkedArray):
        ids = ids.combine_chunks()
    count = np.asarray(pc.fill_null(pc.list_value_length(ids), 0), dtype=np.int64)
    values = np.asarray(pc.fill_null(pc.list_flatten(ids), -1), dtype=np.int32)
    return pa.array([x.decode("utf-8", "replace") for x in raw_bytes(values, count, v)], pa.string())


_SHARED: dict = {}


def _vocabulary(spark, model: str):
    """The vocabulary, sent to the workers once for each application: a few MB, whatever the corpus."""
    key = ready(spark).sparkContext.applicationId, model
    if key not in _SHARED:
        _SHARED[key] = spark.sparkContext.broadcast(Vocabulary(model))
    return _SHARED[key]


def encode(docs: DataFrame, text: str = "text", out: str = "ids", model: str = MODEL) -> DataFrame:
    """``docs`` with the piece ids of ``text`` as array<int>."""
    held = _vocabulary(docs.sparkSession, model)
    encoders: list[Encoder] = []

    @F.arrow_udf("array<int>")
    def ids(x: pa.Array) -> pa.Array:
        if not encoders:
            encoders.append(Encoder(held.value))
        return encode_batch(x, encoders[0])

    return docs.withColumn(out, ids(F.col(text)))


def decode(docs: DataFrame, ids: str = "ids", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """``docs`` with the text that ``ids`` stand for."""
    held = _vocabulary(docs.sparkSession, model)

    @F.arrow_udf("string")
    def texts(x: pa.Array) -> pa.Array:
        return decode_batch(x, held.value)

    return docs.withColumn(out, texts(F.col(ids)))


def encode_checked(docs: DataFrame, text: str = "text", model: str = MODEL) -> DataFrame:
    """``docs`` with ``ids``, ``n_pieces``, ``ids_crc32`` (of little-endian unsigned 32-bit ids) and
    ``lossless``: decoding them gives the text back. One pass, texts do not leave the task."""
    held = _vocabulary(docs.sparkSession, model)
    encoders: list[Encoder] = []

    @F.arrow_udf("ids array<int>, n_pieces long, ids_crc32 long, lossless boolean")
    def checked(x: pa.Array) -> pa.Array:
        if not encoders:
            encoders.append(Encoder(held.value))
        flats, counts, crc, same = [], [], [], []
        for c in tk.chunks(x):
            flat, count = encoders[0].encode(c)
            raw, edge = flat.astype("<u4").tobytes(), np.concatenate(([0], 4 * np.cumsum(count))).tolist()
            crc += [zlib.crc32(raw[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)]
            texts, place = c.data.tobytes(), c.offsets.tolist()
            same += [r == texts[a:b] for r, a, b in zip(raw_bytes(flat, count, held.value), place[:-1], place[1:], strict=True)]
            flats.append(flat)
            counts.append(count)
        n = np.concatenate(counts) if counts else np.empty(0, np.int64)
        offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flats).astype(np.int32) if flats else np.empty(0, np.int32)))
        return pa.StructArray.from_arrays([ids, pa.array(n), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], ["ids", "n_pieces", "ids_crc32", "lossless"])

    new = ("ids", "n_pieces", "ids_crc32", "lossless")
    keep = [c for c in docs.columns if c not in new]
    return docs.select(*keep, checked(F.col(text)).alias("_pieces")).select(*keep, "_pieces.*")
