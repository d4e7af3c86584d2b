import collections
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from driftlog.llm import quality, toxicity
from tests.llm.conftest import words

NO_LABELS = "doc_id long, quality int, toxic int"


def stats(text):
    text = text or ""
    w = words(text)
    grams = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    inside = {i + k for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if grams[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_statistics_equal_brute_force(documents, awkward):
    for df in (documents, awkward):
        for r in quality.text_stats(df).select("text", *quality.BASE_STATS).collect():
            assert tuple(r[1:]) == stats(r["text"])


def test_rules_find_planted_junk_and_keep_the_rest():
    rng = np.random.default_rng(1)
    x = {"a": rng.random(900), "b": rng.random(900), "c": rng.random(900)}
    bad = (x["a"] > 0.8) & (x["b"] <= 0.5) | (x["c"] > 0.95)
    rules = quality.learn_rules(x, bad)
    hit = np.zeros(900, bool)
    for r in rules:
        hit |= quality._covers(x, r, 900)
    assert len(rules) >= 2 and (hit == bad).mean() > 0.97
    assert quality.learn_rules(x, np.zeros(900, bool)) == []
    assert quality.learn_rules({k: v[:0] for k, v in x.items()}, bad[:0]) == []


def test_rules_are_one_ordered_expression(spark):
    rules = [(quality.Condition("a", True, 5.0),), (quality.Condition("a", True, 1.0), quality.Condition("b", False, 2.0))]
    df = spark.createDataFrame([(9.0, 0.0), (3.0, 1.0), (3.0, 9.0)], "a double, b double")
    got = [r[0] for r in df.select(quality.rules_expr(rules, {"a": F.col("a"), "b": F.col("b")})).collect()]
    assert got == [1, 2, 0]


def test_quality_on_awkward_and_empty(spark, awkward, nothing):
    none = spark.createDataFrame([(None, 0, 1), (1, None, None)], NO_LABELS)
    rows = quality.quality_rules(awkward, none).select("doc_id", "base_failed", "kept", "n_words").collect()
    assert len(rows) == 12 and all(r["kept"] is (not r["base_failed"]) for r in rows)
    assert [r["kept"] for r in rows if r["doc_id"] == 6] == [True]
    assert quality.quality_rules(nothing, none).count() == 0


def test_noisy_or_and_offending_sentences(spark, awkward, nothing):
    word = lambda w: int(toxicity.tk.run_hashes(np.frombuffer(w, np.uint8), toxicity.tk.Runs(np.array([0]), np.array([len(w)]), np.array([0])))[0] >> np.uint64(64 - toxicity.BITS))
    weights = np.zeros(1 << toxicity.BITS, np.float32)
    weights[word(b"idiot")] = 6.0
    model = toxicity.Model(weights, -3.0)
    rows = {r["doc_id"]: r for r in toxicity.score(awkward, model).select("doc_id", "text", "score", "offending").collect()}
    s = lambda z: 1 / (1 + np.exp(-z))
    assert abs(rows[9]["score"] - (1 - (1 - s(3.0)) * (1 - s(-3.0)))) < 1e-6
    (span,) = rows[9]["offending"]
    assert rows[9]["text"][span["start"] : span["end"]] == "You are an idiot"
    assert rows[3]["score"] == rows[4]["score"] == 0.0 and rows[5]["offending"] == []
    assert toxicity.score(nothing, model).count() == 0


def test_training_finds_the_word_and_never_uses_held_out_rows(spark):
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, f"plain{i % 7} text here. {'some grumbleword there' if bad else 'nothing else'}. more"))
        held = zlib.crc32(str(i).encode()) % 3 == 1
        labels.append((i, 1, int(bad) if not held else 1 - int(bad)))  # held-out labels are wrong on purpose
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (None, 1, 1), (0, 1, None)], NO_LABELS)
    scored = toxicity.score(docs, toxicity.train(docs, lab)).select("doc_id", "score").collect()
    assert all((r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in scored)
    assert toxicity.train(docs, lab.where("toxic = 0")).weights.any() == False  # noqa: E712


def test_sentences_split_at_stops():
    c = next(toxicity.tk.chunks(__import__("pyarrow").array(["One two. Three! four\nfive?"])))
    _, sentence, spans = toxicity._sentences(c)
    assert sentence.tolist() == [0, 0, 1, 2, 3] and len(spans.start) == 4
    assert re.findall(r"[A-Za-z]+", "One two.") == ["One", "two"]
