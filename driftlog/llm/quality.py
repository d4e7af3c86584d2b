"""Quality rules: a learned decision list over text statistics.

``text_stats`` counts whole texts; ``learn_rules`` grows and prunes threshold conjunctions by
sequential covering on labelled statistics; ``rules_expr`` emits the list as one ordered Spark
conditional expression, so applying it is plain column work.

Defined results: a null or empty text has all counts 0 and fails the base rule (fewer than 50
words). Labels with a null id or null quality are not used; a document labelled more than once
counts as bad if any label says so. Without labels of both kinds the list is empty and every text
that passes the base rule is kept. Ties between equally good conditions go to the first feature,
then the lowest threshold. Repeated rows get equal results, other columns of the input pass
through untouched unless their names equal an output column, which then wins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.llm import textkit as tk
from driftlog.llm.common import ready

#: Labelled documents that the list is learned from, at most (by ascending hash of the id).
MAX_LABELLED = 8_000
BASE_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_STATS = ("n_lines", "n_upper", "n_letters", "n_digits", "n_stops", "n_distinct")
STATS = BASE_STATS + MORE_STATS

_SYMBOL = tk.byte_set(b"#*$%&|<>")
_WORD_HEAD = tk.HEAD & ~tk.SPACE
_UPPER = tk.byte_set(bytes(range(65, 91)))
_LETTER = tk.byte_set(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0xC2, 0xF5)))
_DIGIT = tk.byte_set(b"0123456789")
_STOP = tk.byte_set(b".!?")
_NEWLINE = tk.byte_set(b"\n")


def _repeats(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur more than once; is it not the first of its kind."""
    if not len(key):
        return np.empty(0, bool), np.empty(0, bool)
    order = np.argsort(key, kind="stable")
    k = key[order]
    later = np.concatenate(([False], k[1:] == k[:-1]))
    many = later | np.concatenate((later[1:], [False]))
    out_many, out_later = np.empty(len(key), bool), np.empty(len(key), bool)
    out_many[order], out_later[order] = many, later
    return out_many, out_later


def _chunk_stats(c: tk.Chunk) -> dict[str, np.ndarray]:
    count = lambda doc: np.bincount(doc, minlength=c.n)
    w = tk.runs(c, tk.SPACE)
    h = tk.run_hashes(c.data, w)
    salt = tk.mix(w.doc.astype(tk.U64) + tk.U64(1))
    at = tk.window_starts(w.doc, 3)
    key, _ = tk.windows(h, w.doc, 3)
    many, _ = _repeats(key ^ salt[at])
    repeated = np.zeros(len(w.start) + 3, bool)
    for k in range(3):
        repeated[at[many] + k] = True
    _, seen = _repeats(h ^ salt)

    lines = tk.runs(c, _NEWLINE)
    word_at = np.concatenate(([0], np.cumsum(np.bincount(w.start, minlength=len(c.data)), dtype=np.int64)))
    with_word = word_at[lines.end] > word_at[lines.start]
    lines = tk.Runs(*(x[with_word] for x in lines))
    _, again = _repeats(tk.run_hashes(c.data, lines) ^ tk.mix(lines.doc.astype(tk.U64) + tk.U64(1)))
    return {
        "n_words": count(w.doc),
        "word_chars": tk.per_text(c, _WORD_HEAD),
        "n_symbols": tk.per_text(c, _SYMBOL),
        "n_dup_lines": count(lines.doc[again]),
        "n_repeat_words": count(w.doc[repeated[: len(w.doc)]]),
        "n_lines": count(lines.doc),
        "n_upper": tk.per_text(c, _UPPER),
        "n_letters": tk.per_text(c, _LETTER),
        "n_digits": tk.per_text(c, _DIGIT),
        "n_stops": tk.per_text(c, _STOP),
        "n_distinct": count(w.doc[~seen]),
    }


def batch_stats(texts: pa.Array) -> pa.StructArray:
    """The statistics of a batch of texts."""
    parts = [_chunk_stats(c) for c in tk.chunks(texts)]
    cols = [np.concatenate([p[k] for p in parts]) if parts else np.empty(0, np.int64) for k in STATS]
    return pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in cols], list(STATS))


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one long column for each of ``STATS``, counted over whole texts."""
    ready(docs.sparkSession)

    @F.arrow_udf(", ".join(f"{k} long" for k in STATS))
    def stats(x: pa.Array) -> pa.Array:
        return batch_stats(x)

    keep = [c for c in docs.columns if c not in STATS]
    return docs.select(*keep, stats(F.col(text)).alias("_stats")).select(*keep, "_stats.*")


def features() -> dict[str, Column]:
    """What the rules test: ratios of the statistics, safe for empty texts."""
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "word_length": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "upper_share": per("n_upper", "n_letters"),
        "digit_share": per("n_digits", "word_chars"),
        "stops_per_word": per("n_stops", "n_words"),
        "distinct_share": per("n_distinct", "n_words"),
        "words_per_line": per("n_words", "n_lines"),
        "n_words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float


Rule = tuple[Condition, ...]


def _covers(x: dict[str, np.ndarray], rule: Rule, n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for c in rule:
        hit &= x[c.feature] > c.threshold if c.above else x[c.feature] <= c.threshold
    return hit


def _best_condition(x, bad, hit, thresholds):
    """The condition with the largest FOIL gain among the rows that ``hit`` covers."""
    p0, n0 = int((hit & bad).sum()), int(hit.sum())
    base, best, found = np.log2(p0 / n0), 1e-9, None
    for name, cuts in thresholds.items():
        values, is_bad = x[name][hit], bad[hit]
        slot = np.searchsorted(cuts, values, "left")  # rows of slot <= k are <= cuts[k]
        below_n = np.cumsum(np.bincount(slot, minlength=len(cuts) + 1))[:-1]
        below_p = np.cumsum(np.bincount(slot[is_bad], minlength=len(cuts) + 1))[:-1]
        for above, p, n in ((True, p0 - below_p, n0 - below_n), (False, below_p, below_n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - base), 0.0)
            k = int(np.argmax(gain)) if len(gain) else 0
            if len(gain) and gain[k] > best:
                best, found = float(gain[k]), Condition(name, above, float(cuts[k]))
    return found


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 12, max_conditions: int = 4,
                min_cover: int = 8, min_precision: float = 0.7, seed: int = 7) -> list[Rule]:
    """Sequential covering: rules for ``bad`` rows, in order.

    Each round splits the rows not yet covered into two thirds to grow on and one third to prune
    on. A rule grows by the condition of the largest FOIL gain until it covers bad rows only, then
    loses trailing conditions while (p - n) / (p + n) on the pruning rows does not fall. The list
    ends when a rule covers too few rows or is not precise enough on the rows it was pruned on.
    """
    n = len(bad)
    rng = np.random.default_rng(seed)
    left = np.ones(n, bool)
    cuts = {k: np.unique(np.quantile(v, np.linspace(0, 1, 101)[1:-1])) for k, v in x.items()} if n else {}
    cuts = {k: np.unique((c[1:] + c[:-1]) / 2) if len(c) > 1 else c for k, c in cuts.items()}
    rules: list[Rule] = []
    while len(rules) < max_rules and (left & bad).any() and (left & ~bad).any():
        grow = left & (rng.random(n) < 2 / 3)
        prune = left & ~grow
        rule: Rule = ()
        while len(rule) < max_conditions:
            hit = grow & _covers(x, rule, n)
            if not (hit & bad).any() or not (hit & ~bad).any():
                break
            c = _best_condition(x, bad, hit, cuts)
            if c is None:
                break
            rule = (*rule, c)
        if not rule:
            break

        def value(r: Rule) -> float:
            hit = prune & _covers(x, r, n)
            p, q = int((hit & bad).sum()), int((hit & ~bad).sum())
            return (p - q) / (p + q) if p + q else -1.0

        while len(rule) > 1 and value(rule[:-1]) >= value(rule):
            rule = rule[:-1]
        hit = left & _covers(x, rule, n)
        p, q = int((hit & bad).sum()), int((hit & ~bad).sum())
        if p + q < min_cover or p / (p + q) < min_precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def rules_expr(rules: list[Rule], columns: dict[str, Column]) -> Column:
    """The list as one ordered conditional expression: the number of the first rule that fires, 0 if none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        test = F.lit(True)
        for c in rule:
            col = columns[c.feature]
            test = test & (col > F.lit(c.threshold) if c.above else col <= F.lit(c.threshold))
        out = F.when(test, F.lit(k)) if out is None else out.when(test, F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def labelled_stats(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED):
    """Features and badness of at most ``max_labelled`` labelled documents, as arrays on the driver."""
    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg((F.min("quality") == 0).alias("_bad"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_labelled)
    )
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    rows = text_stats(picked).select("_id", F.struct("_bad", *(v.alias(k) for k, v in features().items())).alias("_row"))
    data = rows.groupBy("_id").agg(F.min("_row").alias("_row")).select("_row.*").toPandas()  # of rows with one id, one
    order = np.lexsort([data[k].to_numpy() for k in data.columns])  # the split must not depend on row order
    x = {k: data[k].to_numpy(float)[order] for k in features()}
    return x, data["_bad"].to_numpy(bool)[order]


def base_failed() -> Column:
    """The fixed rule: fewer than 50 words, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``rule`` (the first that fires, 0 if none) and ``kept``."""
    out = text_stats(docs)
    return out.withColumns({"base_failed": base_failed(), "rule": rules_expr(rules, features())}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )


def quality_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Learn the list from ``labels`` (doc_id, quality 0/1) and judge all of ``docs``."""
    return judge(docs, learn_rules(*labelled_stats(docs, labels, max_labelled)))
