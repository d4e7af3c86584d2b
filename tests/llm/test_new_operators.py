"""Clustering, repeated strings and importance resampling against plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from driftlog.llm import importance, lloyd, suffixes
from driftlog.llm import textkit as tk
from tests.llm.conftest import SF


# ---- repeated strings


def brute_spans(texts, length=suffixes.LENGTH):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(hashlib.md5(b[i : i + length]).digest() for b in raw for i in range(len(b) - length + 1))
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[hashlib.md5(b[i : i + length]).digest()] > 1:
                gone[i : i + length] = True
        starts = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int)))) == 1)
        yield len(b), int(gone.sum()), len(starts), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()


def removed(df):
    return sorted((tuple(r) for r in suffixes.deduplicated(df).collect()), key=str)


def test_repeated_strings_equal_brute_force(documents):
    rows = documents.select("doc_id", "text").collect()
    want = [(r["doc_id"], *s) for r, s in zip(rows, brute_spans([r["text"] for r in rows]), strict=True)]
    assert removed(documents) == sorted(want, key=str)
    assert sum(w[2] for w in want) > 0


def hard_texts():
    rng = random.Random(1)
    word = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    passage = word(900, "abcdefgh é")
    texts = ["a" * 1500, "a" * 401, "ab" * 700, None, "", passage, passage[:450], passage[100:520] + "x" * 30]
    texts += [word(300, "xyz") + passage[k : k + 500] + word(300, "xyz") for k in range(0, 400, 7)]  # a passage among different neighbours
    texts += [passage[:k] + "#" + passage[k:] for k in range(0, 900, 13)]
    return texts + [("abcdefghij" * 100)[k : k + 600 + k] for k in range(20)]


@pytest.mark.parametrize(("members", "piece"), [(suffixes.MEMBERS, suffixes.PIECE), (4, 700)])
def test_hard_repeats_equal_brute_force(spark, monkeypatch, members, piece):
    """Also with keys of few members (split down to single windows) and texts in small pieces."""
    monkeypatch.setattr(suffixes.repeated_runs, "__defaults__", (suffixes.SPAN, suffixes.LENGTH, members))
    texts = hard_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    if piece != suffixes.PIECE:  # workers import the module anew: cut the pieces here
        monkeypatch.setattr(suffixes, "PIECE", piece)
        import pyarrow as pa

        whole = [x for u in suffixes.units(pa.array(texts)) for x in windows_of(u)]
        monkeypatch.undo()
        assert sorted(whole) == sorted(x for u in suffixes.units(pa.array(texts)) for x in windows_of(u))
        monkeypatch.setattr(suffixes.repeated_runs, "__defaults__", (suffixes.SPAN, suffixes.LENGTH, members))
    assert removed(df) == sorted(((k, *s) for k, s in enumerate(brute_spans(texts))), key=str)


def windows_of(unit):
    doc, at, n, t_lo, key, _ = unit
    for d, a, m, t, k in zip(doc.tolist(), at.tolist(), n.tolist(), t_lo.tolist(), key.tolist(), strict=True):
        yield from ((d, a + i, t + m - 1 - i, k) for i in range(m))


def test_equal_windows_have_equal_keys():
    import pyarrow as pa

    texts = hard_texts()
    keys = collections.defaultdict(set)
    for u in suffixes.units(pa.array(texts)):
        for d, a, t, k in windows_of(u):
            keys[texts[d].encode()[a : a + suffixes.LENGTH]].add((k, t))
    assert all(len(v) == 1 for v in keys.values()) and len(keys) > 1000


def test_merged_transforms_against_sets():
    rng = np.random.default_rng(4)
    length, span = 24, 9
    for _ in range(30):
        m = int(rng.integers(1, 60))
        group = np.sort(rng.integers(0, 4, m))
        rows = rng.integers(97, 99, (m, span - 1 + length)).astype(np.uint8)
        rows[:, span:-4] = 97
        lo = rng.integers(0, span, m)
        n = np.array([rng.integers(1, span - x + 1) for x in lo])
        for r in range(m):  # zeros where a member has no bytes
            rows[r, : span - lo[r] - n[r]] = 0
            rows[r, span - 1 - lo[r] + length :] = 0
        w = rng.integers(1, 3, m)
        got = suffixes.merged(group, rows, n, lo, w, span, length)
        seen = collections.Counter()
        at = lambda r, t: (group[r], t, rows[r, span - 1 - t : span - 1 - t + length].tobytes())
        for r in range(m):
            for t in range(lo[r], lo[r] + n[r]):
                seen[at(r, t)] += w[r]
        want = np.zeros((span, m), bool)
        for r in range(m):
            for t in range(lo[r], lo[r] + n[r]):
                want[t, r] = seen[at(r, t)] >= 2
        assert (got == want).all()


@pytest.mark.parametrize(("size", "gone"), [(399, 0), (400, 400), (401, 401)])
def test_a_passage_of_many_words_is_judged_by_its_bytes(spark, size, gone):
    """A passage of over 50 words that two documents share stays below 400 bytes and goes from there on."""
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = " ".join(word(6) for _ in range(56)) + " " + word(size - 56 * 7)
    assert len(passage) == size and len(passage.split()) == 57
    rows = [(k, f"{word(200)}{x}{passage}{x}{word(200)}") for k, x in enumerate("XY")]
    assert [r[2:4] for r in removed(spark.createDataFrame(rows, "doc_id long, text string"))] == [(gone, min(gone, 1))] * 2


def test_repeats_on_awkward_and_empty(awkward, nothing):
    rows = awkward.select("doc_id", "text").collect()
    assert removed(awkward) == sorted(((r["doc_id"], *s) for r, s in zip(rows, brute_spans([r["text"] for r in rows]), strict=True)), key=str)
    assert suffixes.deduplicated(nothing).count() == 0
    out = suffixes.deduplicated(awkward.where("doc_id is null").unionByName(awkward.where("doc_id is null")))
    assert [r["n_removed"] for r in out.collect()] == [0, 0]  # 19 bytes are too short to repeat


# ---- importance resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(text)
    return len(w), [zlib.crc32(" ".join(w[k : k + n]).encode()) % 10_000 for n in (1, 2, 3) for k in range(len(w) - n + 1)]


def brute_resample(rows, target):
    of = [(i, *features(t)) for i, t in rows]
    count = lambda lists: np.bincount(np.array([x for f in lists for x in f], int), minlength=10_000).tolist()
    s, t = count([f for _, _, f in of]), count([features(x)[1] for x in target])
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000)))) for a, b in zip(s, t, strict=True)]
    out = []
    for i, n, f in of:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    order = sorted((k for k in range(len(out)) if out[k][5] >= 20), key=lambda k: (-out[k][3], out[k][0] is None, out[k][0]))
    for rank, k in enumerate(order[: 5 * len(order) // 100], 1):
        out[k][4] = rank
    return sorted((tuple(x[:5]) for x in out), key=str)


def resampled(docs, target):
    return sorted((tuple(r) for r in importance.resample(docs, target).collect()), key=str)


def test_resampling_equals_brute_force(spark, documents, awkward, nothing):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = [r["text"] for r in target.collect()]
    for df in (documents, awkward):
        assert resampled(df, target) == brute_resample([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()], texts)
    assert resampled(documents, nothing) == brute_resample([(r["doc_id"], r["text"]) for r in documents.collect()], [])
    assert importance.resample(nothing, target).count() == 0


def test_tied_and_repeated_rows_take_ranks_of_their_own(spark):
    text = " ".join(f"w{k}" for k in range(25))
    df = spark.createDataFrame([(7, text)] * 60 + [(8, "short")], "doc_id long, text string").selectExpr("*", "1 as rank", "2 as weight")
    ranks = sorted(r["rank"] for r in importance.resample(df, df).collect() if r["rank"] is not None)
    assert ranks == [1, 2, 3]


def test_crcs_of_substrings():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 150_000).astype(np.uint8)
    raw = data.tobytes()
    lo = np.append(rng.integers(0, len(raw), 400), [0, 0, 256, len(raw)])
    hi = np.minimum(lo + np.append(rng.integers(0, 90_000, 400), [0, len(raw), 256, 0]), len(raw))
    a, b = np.split(importance.prefix_crcs(data, np.concatenate((lo, hi))), 2)
    assert importance.substring_crcs(a, b, hi - lo).tolist() == [zlib.crc32(raw[i:j]) for i, j in zip(lo, hi, strict=True)]


def test_features_of_long_words_and_other_scripts():
    import pyarrow as pa

    texts = ["x" * 70_000 + " Ééé-ÀB cd漢字　z\x7f9", None, "", "-- __", "one"]
    got = collections.defaultdict(list)
    for c in tk.chunks(pa.array(texts)):
        bucket, doc, _ = importance.feature_buckets(c)
        for b, d in zip(bucket.tolist(), doc.tolist(), strict=True):
            got[d + c.first].append(b)
    assert all(sorted(got[k]) == sorted(features(t)[1]) for k, t in enumerate(texts))


# ---- clustering


def brute_clusters(rows, k=40, rounds=5):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    first = sorted((r for r in kept if r[0] is not None), key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    x, c = np.array([v for _, v in kept]), np.array([v for _, v in first])
    for step in range(rounds + 1):
        d = ((x[:, None, :] - c[None]) ** 2).sum(-1)
        label = d.argmin(1)
        if step < rounds:
            c = np.array([x[label == j].sum(0) // (label == j).sum() if (label == j).any() else c[j] for j in range(len(c))])
    least = d.min(1)
    name = [hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in c.tolist()]
    return sorted(((kept[r][0], int(label[r]), int(least[r]), int(least[label == label[r]].sum()), int(least.sum()), name[label[r]]) for r in range(len(kept))), key=str)


def clustered(df):
    return sorted((tuple(r) for r in lloyd.cluster(df).collect()), key=str)


def test_clusters_equal_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert clustered(df) == brute_clusters([(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_clusters_on_awkward_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(64).tolist()) for i in range(30)] + [(3, rng.standard_normal(64).tolist())] * 2
    rows += [(900, None), (901, []), (902, [0.0] * 64), (903, [None] + [0.0] * 63), (904, [float("nan")] * 64), (905, [1.0] * 63), (906, [float("inf")] * 64), (None, [0.5] * 64)]
    rows += [(907, (rng.standard_normal(64) * 50_000).tolist())]  # products past 2^52 go through whole numbers
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as cluster", "'x' as data", "2 as g")
    assert clustered(df) == brute_clusters(rows)
    assert lloyd.cluster(df.where("vec_id = 900")).count() == lloyd.cluster(df.limit(0)).count() == 0
    assert lloyd.cluster(df.limit(0)).columns == lloyd.cluster(df).columns
