"""Toxicity by multiple-instance learning: a text is toxic if one of its sentences is.

A sentence's score is a logistic function of the weights of its hashed words; the scores of a
text's sentences are combined by noisy-or, P = 1 - prod(1 - p_s), and the weights are trained from
document labels alone. The trained sentence scores then locate the offending sentences.

Words here are runs of letters (A-Z folded to lower case, any non-ASCII byte counts as a letter);
sentences end at ``.``, ``!``, ``?`` or a line break.

Defined results: null and empty texts have no sentence, score 0.0 and no offending span. Labels
with a null id or null ``toxic`` are not used; a document with several labels is toxic if one of
them says so; a row with a null id is never held out and never learned from. Without labels of
both kinds all weights stay 0 and every score is near 0. Repeated rows get equal scores. Other
columns pass through; an input column named like an output column is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm import textkit as tk
from driftlog.llm.common import doc_mod, ready

#: Labelled documents of each kind that the weights are trained on, at most (by ascending hash of the id).
MAX_TOXIC, MAX_CLEAN = 1_500, 3_000
#: Longer texts are scored like any other, but not sampled for training; of rows with one id, one is.
MAX_SAMPLED_BYTES = 1 << 20
FOLDS, HELD_OUT_FOLD = 3, 1
THRESHOLD = 0.7
#: Hashed word weights: 2**20 four-byte floats.
BITS = 20
MIN_DOCS = 4

_NOT_LETTER = np.array([not (65 <= b <= 90 or 97 <= b <= 122 or b >= 0x80) for b in range(256)])
_STOP = tk.byte_set(b".!?\n")


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def _sentences(c: tk.Chunk):
    """Hashed words of a chunk with their sentences; sentence spans in bytes; texts of the sentences."""
    low = tk.LOWER[c.data]
    w = tk.runs(c, _NOT_LETTER)
    word = (tk.run_hashes(low, w) >> tk.U64(64 - BITS)).astype(np.int64)
    s = tk.runs(c, _STOP)
    sentence = np.searchsorted(s.start, w.start, "right") - 1
    return word, sentence, s


def batch_scores(texts: pa.Array, m: Model) -> pa.StructArray:
    """Score and offending sentences (code-point spans, own score) of every text of a batch."""
    score, counts, starts, ends, probs = [], [], [], [], []
    for c in tk.chunks(texts):
        word, sentence, s = _sentences(c)
        z = np.full(len(s.start), m.bias) + np.bincount(sentence, m.weights[word], minlength=len(s.start))
        z[np.bincount(sentence, minlength=len(s.start)) == 0] = -np.inf  # no word, no score
        rest = np.bincount(s.doc, np.logaddexp(0.0, z), minlength=c.n)
        score.append(-np.expm1(-rest))
        hit = z >= 0.0
        heads = np.concatenate(([0], np.cumsum(tk.HEAD[c.data], dtype=np.int64)))
        zero = heads[c.offsets[:-1]][s.doc[hit]]
        starts.append(heads[s.start[hit]] - zero)
        ends.append(heads[s.end[hit]] - zero)
        probs.append(1.0 / (1.0 + np.exp(-z[hit])))
        counts.append(np.bincount(s.doc[hit], minlength=c.n))
    join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.empty(0, kind)
    spans = pa.StructArray.from_arrays(
        [pa.array(join(starts, np.int64)), pa.array(join(ends, np.int64)), pa.array(join(probs, float))], ["start", "end", "score"]
    )
    offsets = np.concatenate(([0], np.cumsum(join(counts, np.int64)))).astype(np.int32)
    return pa.StructArray.from_arrays(
        [pa.array(np.clip(join(score, float), 0.0, 1.0)), pa.ListArray.from_arrays(pa.array(offsets), spans)], ["score", "offending"]
    )


def _bags(texts: pa.Array) -> pa.Array:
    """Each text as int32 values: hashed words, with -1 between sentences."""
    out = []
    for c in tk.chunks(texts):
        word, sentence, s = _sentences(c)
        doc = s.doc[sentence] if len(word) else np.empty(0, np.int64)
        # a word's place moves right by one for every sentence before its own
        values = np.full(len(word) + len(s.start), -1, np.int32)
        values[np.arange(len(word)) + sentence] = word
        edge = np.bincount(doc, minlength=c.n) + np.bincount(s.doc, minlength=c.n)
        offsets = np.concatenate(([0], np.cumsum(edge)))
        out += [values[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return pa.array(out, pa.binary())


def fit(bags: list[bytes], toxic: np.ndarray, rounds: int = 150, rate: float = 0.3, l1: float = 0.15) -> Model:
    """Train word weights and the bias on bags of sentences by Adam with soft thresholding.

    The penalty is ``l1`` over the number of documents: the more evidence, the less of it.
    """
    weights = np.zeros(1 << BITS, np.float32)
    if not len(bags) or toxic.all() or not toxic.any():
        return Model(weights, -12.0)
    flat = [np.frombuffer(b, np.int32) for b in bags]
    size = np.array([len(x) for x in flat])
    values = np.concatenate(flat)
    doc = np.repeat(np.arange(len(flat)), size)
    sentence = np.cumsum(values < 0) - (values < 0)
    word_doc, word_sentence, word = doc[values >= 0], sentence[values >= 0], values[values >= 0]
    pairs = np.unique(word_doc * (1 << BITS) + word)
    docs_with = np.bincount(pairs & ((1 << BITS) - 1), minlength=1 << BITS)
    used = np.flatnonzero(docs_with >= MIN_DOCS)
    slot = np.full(1 << BITS, -1, np.int64)
    slot[used] = np.arange(len(used))
    col = slot[word]
    live = np.unique(word_sentence)
    owner = np.zeros(len(live), np.int64)
    at = np.searchsorted(live, word_sentence)
    owner[at] = word_doc
    at, col = at[col >= 0], col[col >= 0]
    n_docs, n_sent, n_col = len(flat), len(live), len(used)
    w, b = np.zeros(n_col), -4.0
    mean, var = np.zeros(n_col + 1), np.zeros(n_col + 1)
    y = toxic.astype(float)
    for t in range(1, rounds + 1):
        z = b + np.bincount(at, w[col], minlength=n_sent)
        total = np.bincount(owner, np.logaddexp(0.0, z), minlength=n_docs)
        p = np.clip(-np.expm1(-total), 1e-9, 1.0)
        pull = (1 - y) - y * (1 - p) / p
        g_z = pull[owner] / (1.0 + np.exp(-np.clip(z, -60, 60)))
        g = np.concatenate((np.bincount(col, g_z[at], minlength=n_col), [g_z.sum()])) / n_docs
        mean = 0.9 * mean + 0.1 * g
        var = 0.99 * var + 0.01 * g * g
        step = rate * (mean / (1 - 0.9**t)) / (np.sqrt(var / (1 - 0.99**t)) + 1e-6)
        # the penalty in the parameter's own step size: weights that the data do not hold up go to 0
        w -= step[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - rate * l1 / n_docs / (np.sqrt(var[:-1] / (1 - 0.99**t)) + 1e-6), 0.0)
        b -= step[-1]
    weights[used] = w
    return Model(weights, float(b))


def training_bags(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> DataFrame:
    """_id, _toxic and bag of the sampled training documents: one row for each sampled id."""

    @F.arrow_udf("binary")
    def bags(x: pa.Array) -> pa.Array:
        return _bags(x)

    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (doc_mod("doc_id", FOLDS) != HELD_OUT_FOLD))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max("toxic").alias("_toxic"))
    )
    some = lambda kind, n: marked.where(F.col("_toxic") == kind).orderBy(F.xxhash64("_id"), "_id").limit(n)
    sample = some(1, max_toxic).unionByName(some(0, max_clean))
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).where(F.octet_length("text") <= MAX_SAMPLED_BYTES)
    return rows.select("_id", "_toxic", bags("text").alias("bag")).groupBy("_id", "_toxic").agg(F.min("bag").alias("bag"))


def _fit_task(batches):
    """The model of all rows of a partition."""
    rows = sorted((r for b in batches for r in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(1).to_pylist(), strict=True)), key=lambda r: r[:2])
    m = fit([r[1] for r in rows], np.array([r[2] == 1 for r in rows], bool))
    yield pa.RecordBatch.from_arrays([pa.array([m.weights.tobytes()], pa.binary()), pa.array([m.bias])], ["weights", "bias"])


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    """Weights learned from the labelled documents of the training folds.

    The sample (its size has a bound) goes to one task, which fits the model; the driver gets the weights alone.
    """
    ready(docs.sparkSession)
    fitted = training_bags(docs, labels, max_toxic, max_clean).repartition(1).mapInArrow(_fit_task, "weights binary, bias double").toArrow()
    if not fitted.num_rows:  # no task had anything to say
        return fit([], np.empty(0, bool))
    return Model(np.frombuffer(fitted["weights"][0].as_buffer(), np.float32), fitted["bias"][0].as_py())


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``offending``: spans (start, end in code points, score) of
    the sentences that are toxic on their own."""
    spark = ready(docs.sparkSession)
    held = spark.sparkContext.broadcast((model.weights, model.bias))  # 4 MB whatever the corpus

    @F.arrow_udf("score double, offending array<struct<start: long, end: long, score: double>>")
    def scored(x: pa.Array) -> pa.Array:
        return batch_scores(x, Model(*held.value))

    keep = [c for c in docs.columns if c not in ("score", "offending")]
    return docs.select(*keep, scored(F.col(text)).alias("_toxic")).select(*keep, "_toxic.*")
