"""Token ids in compressed binary shards.

Every document's ids (an end id appended) are serialized as little-endian unsigned 32-bit integers
and compressed as one zstandard frame of their own, with a dictionary shared by all documents that is
trained on serialized arrays. Frames are packed into shards in ascending doc_id order; a shard carries
the dictionary's hash and an index of byte offsets, so one short document can be read without its
neighbours.

File format: a folder with ``dictionary`` (one row: ``hash`` = sha256 hex of the dictionary, ``data``)
and ``shards``, uncompressed Parquet with one row for each shard:

======================= =================================================================
``part, shard``         place in the order: range partition, shard within it
``dict_hash``           dictionary that the frames need
``first_id, last_id``   smallest and largest doc_id (pushed down by ``read_document``)
``n_docs, n_tokens``    totals
``doc_ids``             int64 array, little-endian (a null id is the smallest int64, see ``null_ids``)
``null_ids``            one byte for each document: 1 where doc_id is null
``offsets``             int64 array of n_docs + 1 byte offsets into ``payload``
``counts``              uint32 array: ids of each document
``payload``             the frames, one after another
======================= =================================================================

Ids come from the public tokenizer file named by the ``vocab`` parameter. Its normaliser and splitter
never reach across white space, so a text's ids are those of its ``[^\\x20\\x09-\\x0D]+`` words one
after another; each batch encodes its distinct words once.

Defined results: null and empty texts have the end id alone. Rows come in ascending doc_id order, null
ids first; rows with equal ids are ordered by the crc32 of their ids, then length. Repeated rows are
all written. An empty table gives an empty file set. Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftlog.llm import textkit as tk
from driftlog.llm.common import ready, shared_path

VOCAB = "word_bpe_49k.json"
END_ID = 2
#: The dictionary is trained on at most so many documents (least hashes of their ids), on one window of at most so
#: many ids of each, at a place that a hash of the document's id picks.
DICT_DOCS, DICT_IDS, DICT_BYTES = 2_000, 2_048, 64 << 10
LEVEL = 3
SHARD_BYTES = 4 << 20
#: Distinct pieces of words whose ids a worker keeps between batches, at most (about 40 bytes each).
CACHE_PIECES = 2_000_000
_NULL_ID = np.iinfo(np.int64).min


_APOSTROPHE_OR_LT = tk.byte_set(b"'<")
_ASCII_LETTER = tk.byte_set(bytes(range(65, 91)) + bytes(range(97, 123)))
_ASCII_OTHER = tk.byte_set(bytes(b for b in range(128) if not _ASCII_LETTER[b]))
_WIDE = np.arange(256) >= 0x80


def pieces(c: tk.Chunk) -> tuple[np.ndarray, tk.Runs]:
    """Pieces of words that the tokenizer treats alike wherever they stand, and the bytes to look up.

    The splitter always parts a letter from a mark or digit, so words are cut between an ASCII letter
    and another ASCII character. Words with an apostrophe (contractions) or ``<`` (special tokens)
    stay whole. A-Z is folded in pieces that are ASCII letters only, since the normaliser folds them too.
    """
    w = tk.runs(c, tk.SPACE)
    if not len(w.start):
        return c.data, w
    whole = np.add.reduceat(_APOSTROPHE_OR_LT[c.data].astype(np.int32), w.start) > 0  # bytes between words are white space
    letter, other = _ASCII_LETTER[c.data], _ASCII_OTHER[c.data] & ~tk.SPACE[c.data]
    at = np.flatnonzero((letter[1:] & other[:-1]) | (other[1:] & letter[:-1])) + 1
    word = np.searchsorted(w.start, at, "right") - 1
    at, word = at[(at > w.start[word]) & (at < w.end[word]) & ~whole[word]], word[(at > w.start[word]) & (at < w.end[word]) & ~whole[word]]
    start, end = np.sort(np.concatenate((w.start, at))), np.sort(np.concatenate((w.end, at)))
    doc = np.searchsorted(c.offsets, start, "right") - 1
    letters = np.concatenate(([0], np.cumsum(letter)))
    fold = letters[end] - letters[start] == end - start
    data = c.data.copy()
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start[fold]] += 1
    inside[end[fold]] -= 1
    here = np.cumsum(inside[:-1]) > 0
    data[here] = tk.LOWER[data[here]]
    return data, tk.Runs(start, end, doc)


class WordEncoder:
    """Ids of whole texts, piece by piece, with a bounded cache of pieces already encoded."""

    SEPARATOR = "<|endoftext|>"

    def __init__(self, vocab: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocab))
        self.separator = self.tokenizer.token_to_id(self.SEPARATOR)
        self.cache = tk.Cache(CACHE_PIECES, np.uint32)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of distinct pieces.

        Pieces of a-z need no normalising or splitting: the tokenizer's model takes them directly.
        Others without ``<`` go through in groups, parted by a special token.
        """
        model = self.tokenizer.model
        letters = [k for k, x in enumerate(words) if x.isascii() and x.isalpha()]
        plain = [k for k, x in enumerate(words) if "<" not in x and not (x.isascii() and x.isalpha())]
        other = [k for k, x in enumerate(words) if "<" in x]
        direct = [[t.id for t in model.tokenize(words[k])] for k in letters]
        groups = [plain[k : k + 500] for k in range(0, len(plain), 500)]
        out = self.tokenizer.encode_batch_fast([self.SEPARATOR.join(words[k] for k in g) for g in groups], add_special_tokens=False)
        flat = [np.array(e.ids, np.uint32) for e in out]
        single = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast([words[k] for k in other], add_special_tokens=False)]
        size, ids = np.zeros(len(words), np.int64), []
        for g, x in zip(groups, flat, strict=True):
            ends = np.concatenate((np.flatnonzero(x == self.separator), [len(x)]))
            size[g] = np.diff(ends, prepend=-1) - 1
            ids.append(x[x != self.separator])
        size[other], size[letters] = [len(x) for x in single], [len(x) for x in direct]
        flat_ids = np.concatenate([*ids, *single, np.array([i for x in direct for i in x], np.uint32)])
        place = np.array(plain + other + letters, np.int64)
        order, length = np.argsort(place), size[place]  # back to the order of ``words``
        begin = np.concatenate(([0], np.cumsum(length)[:-1]))
        return size, tk.gather(flat_ids, begin[order], length[order])

    def encode(self, c: tk.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk, and the number of ids of each text (without end ids)."""
        data, w = pieces(c)
        keys, first, back = np.unique(tk.run_hashes(data, w), return_index=True, return_inverse=True)

        def new_ids(new: np.ndarray):
            raw = data.tobytes()
            spans = zip(w.start[first[new]].tolist(), w.end[first[new]].tolist(), strict=True)
            return self._encode([raw[a:b].decode("utf-8", "replace") for a, b in spans])

        begin, size, ids = self.cache.rows(keys, new_ids)
        size = size[back]
        return tk.gather(ids, begin[back], size), np.bincount(w.doc, size, minlength=c.n).astype(np.int64)


@functools.lru_cache(maxsize=1)
def worker_encoder(vocab: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker: the vocabulary is loaded, and a common piece encoded, once."""
    return WordEncoder(vocab)


def encoded(texts: pa.Array, encoder: WordEncoder, end_id: int) -> Iterator[np.ndarray]:
    """The ids of each text, the end id included."""
    for c in tk.chunks(texts):
        flat, count = encoder.encode(c)
        flat = flat.astype("<u4")
        for part in np.split(flat, np.cumsum(count)[:-1]):
            yield np.append(part, np.uint32(end_id)).astype("<u4")


def _dictionary(samples: list[bytes]):
    """A trained dictionary; too few samples to train on give their own content instead."""
    import zstandard as zs

    try:
        return zs.train_dictionary(DICT_BYTES, samples)
    except zs.ZstdError:
        return zs.ZstdCompressionDict(b"".join(samples)[-DICT_BYTES:], dict_type=zs.DICT_TYPE_RAWCONTENT)


def train_dictionary(docs: DataFrame, vocab: str = VOCAB, end_id: int = END_ID, max_docs: int = DICT_DOCS) -> bytes:
    """A shared dictionary from the serialized ids of a bounded sample of documents."""
    ready(docs.sparkSession)

    @F.arrow_udf("binary")
    def sample(x: pa.Array, pick: pa.Array) -> pa.Array:
        enc = worker_encoder(vocab)
        out = []
        for ids, k in zip(encoded(x, enc, end_id), pick.to_pylist(), strict=True):
            at = k % max(1, len(ids) - DICT_IDS + 1)
            out.append(ids[at : at + DICT_IDS].tobytes())
        return pa.array(out, pa.binary())

    ids = docs.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct().orderBy(F.xxhash64("_id"), "_id").limit(max_docs)
    picked = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 40))
    rows = picked.select("doc_id", sample("text", place).alias("b")).groupBy("doc_id").agg(F.min("b").alias("b")).collect()  # one for each id
    samples = [bytes(r["b"]) for r in sorted(rows, key=lambda r: (r["doc_id"], bytes(r["b"])))]
    return _dictionary(samples).as_bytes()


def _compression_dict(data: bytes):
    import zstandard as zs

    trained = data[:4] == b"\x37\xa4\x30\xec"  # the format's own mark of a trained dictionary
    return zs.ZstdCompressionDict(data, dict_type=zs.DICT_TYPE_FULLDICT if trained else zs.DICT_TYPE_RAWCONTENT)


def _frames(docs: DataFrame, dictionary: bytes, vocab: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, crc, frame) of every document; the texts are encoded here, once."""
    schema = "doc_id long, n_tokens long, crc long, frame binary"

    def run(batches):
        import zstandard as zs

        enc = worker_encoder(vocab)
        zc = zs.ZstdCompressor(level=LEVEL, dict_data=_compression_dict(dictionary), write_checksum=True)
        for b in batches:
            n, crc, frame = [], [], []
            for ids in encoded(b.column(1), enc, end_id):
                raw = ids.tobytes()
                n.append(len(ids))
                crc.append(zlib.crc32(raw))
                frame.append(zc.compress(raw))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(frame, pa.binary())],
                ["doc_id", "n_tokens", "crc", "frame"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


SHARDS = (
    "part int, shard long, dict_hash string, first_id long, last_id long, n_docs long, n_tokens long, "
    "doc_ids binary, null_ids binary, offsets binary, counts binary, payload binary"
)


def _pack(dict_hash: str, shard_bytes: int):
    def run(batches):
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        ids, null, counts, frames, size = [], [], [], [], 0

        def row():
            lengths = np.array([len(f) for f in frames], np.int64)
            known = [i for i, x in zip(ids, null, strict=True) if not x]
            values = [
                part, shard, dict_hash, min(known, default=None), max(known, default=None), len(ids), sum(counts),
                np.array(ids, "<i8").tobytes(), bytes(null), np.concatenate(([0], np.cumsum(lengths))).astype("<i8").tobytes(),
                np.array(counts, "<u4").tobytes(), b"".join(frames),
            ]
            kinds = [pa.int32(), pa.int64(), pa.string(), *[pa.int64()] * 4, *[pa.binary()] * 5]
            names = [f.split()[0] for f in SHARDS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for b in batches:
            for doc_id, n, _, frame in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids.append(_NULL_ID if doc_id is None else doc_id)
                null.append(doc_id is None)
                counts.append(n)
                frames.append(frame)
                size += len(frame) + 21
                if size >= shard_bytes:
                    yield row()
                    shard, size = shard + 1, 0
                    ids, null, counts, frames = [], [], [], []
        if ids:
            yield row()

    return run


def write_ids(docs: DataFrame, path: str, vocab: str = VOCAB, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> str:
    """Encode ``docs`` and write the file set at ``path`` (any file system Spark writes to).

    The frames are written once unordered, then range-partitioned by doc_id: the sampling pass of the
    range partitioner reads two columns of that table instead of encoding every text again, and the
    shuffle carries compressed frames, not texts.
    """
    spark = ready(docs.sparkSession)
    dictionary = train_dictionary(docs, vocab, end_id)
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(dict_hash, bytearray(dictionary))], "hash string, data binary").coalesce(1).write.parquet(f"{path}/dictionary")
    loose = shared_path(spark, "token-frames")
    _frames(docs, dictionary, vocab, end_id).write.option("compression", "none").parquet(loose)
    frames = spark.read.schema("doc_id long, n_tokens long, crc long, frame binary").parquet(loose)
    ordered = frames.repartitionByRange(F.col("doc_id"), F.col("crc")).sortWithinPartitions("doc_id", "crc", "n_tokens", "frame")
    ordered.mapInArrow(_pack(dict_hash, shard_bytes), SHARDS).write.option("compression", "none").parquet(f"{path}/shards")
    _delete(spark, loose)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder that this module wrote itself."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _load(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, bytes]]:
    shards = spark.read.schema(SHARDS).parquet(f"{path}/shards")
    rows = spark.read.schema("hash string, data binary").parquet(f"{path}/dictionary").limit(16).collect()
    dictionaries = {r["hash"]: bytes(r["data"]) for r in rows}
    for h, data in dictionaries.items():
        if hashlib.sha256(data).hexdigest() != h:
            raise ValueError(f"dictionary {h} of {path} is damaged")
    return shards, dictionaries


def _documents_of(row: dict) -> Iterator[tuple[int | None, int, bytes]]:
    ids, null = np.frombuffer(row["doc_ids"], "<i8"), row["null_ids"]
    offsets, counts = np.frombuffer(row["offsets"], "<i8"), np.frombuffer(row["counts"], "<u4")
    payload = memoryview(row["payload"])
    for k in range(len(ids)):
        yield (None if null[k] else int(ids[k])), int(counts[k]), payload[offsets[k] : offsets[k + 1]]


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """All documents of a file set: doc_id, start (ids of all documents before it), n_tokens, and their
    ``ids`` (array<long>), or with ``digest`` their ``ids_crc32`` instead."""
    ready(spark)
    shards, dictionaries = _load(spark, path)
    # prefix sums in two steps: over range partitions (one number each comes to the driver), then over a partition's shards
    totals = sorted(shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    begin, at = [], 0
    for part, n in totals:
        begin.append((part, at))
        at += n
    parts = F.broadcast(spark.createDataFrame(begin, "part int, _part_start long"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("_shard_start"))
    starts = starts.join(parts, "part").select("part", "shard", (F.col("_part_start") + F.col("_shard_start")).alias("_start"))
    placed = shards.join(starts, ["part", "shard"]).select("dict_hash", "doc_ids", "null_ids", "offsets", "counts", "payload", "_start")
    schema = "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<long>")

    def run(batches):
        import zstandard as zs

        readers = {h: zs.ZstdDecompressor(dict_data=_compression_dict(d)) for h, d in dictionaries.items()}
        for b in batches:
            for row in b.to_pylist():
                at, out = row["_start"], []
                zd = readers[row["dict_hash"]]
                for doc_id, n, frame in _documents_of(row):
                    raw = zd.decompress(frame)
                    if len(raw) != 4 * n:
                        raise ValueError(f"document {doc_id}: {len(raw) // 4} ids, {n} in the index")
                    out.append((doc_id, at, n, zlib.crc32(raw) if digest else np.frombuffer(raw, "<u4").astype(np.int64)))
                    at += n
                cols = list(zip(*out, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64() if digest else pa.list_(pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)], names)

    return placed.mapInArrow(run, schema)


def read_document(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """The ids of one document: only shards whose id range holds it are read, and only its frame is decompressed."""
    ready(spark)
    shards, dictionaries = _load(spark, path)
    near = shards.where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))

    def run(batches):
        import zstandard as zs

        for b in batches:
            for row in b.to_pylist():
                zd = zs.ZstdDecompressor(dict_data=_compression_dict(dictionaries[row["dict_hash"]]))
                ids, offsets = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["offsets"], "<i8")
                for k in np.flatnonzero(ids == doc_id):
                    raw = zd.decompress(row["payload"][offsets[k] : offsets[k + 1]])
                    yield pa.RecordBatch.from_arrays([pa.array([np.frombuffer(raw, "<u4").astype(np.int64)], pa.list_(pa.int64()))], ["ids"])

    return near.select("dict_hash", "doc_ids", "offsets", "payload").mapInArrow(run, "ids array<long>")
