import collections
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from driftlog.llm import components, neardup, vectors


def roots(edges, nodes):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_equal_union_find(spark):
    random.seed(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + k) for k in range(1, 50)] + [(random.randint(2000, 2400), random.randint(2000, 2400)) for _ in range(250)] + [(7, 7), (5000, 5000)]
    want = {n: r for n, r in roots(edges, {x for e in edges for x in e}).items() if n != 5000}
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {k: v for k, v in got.items()} == {k: v for k, v in want.items() if any(k in e and e[0] != e[1] for e in edges)}


def brute_groups(ids, texts, idf, threshold=0.8):
    sets = neardup._described(pa.array(texts), idf)
    edges = [(i, j) for i in range(len(ids)) for j in range(i) if len(sets[i][0]) and len(sets[j][0]) and neardup._similar(sets[i], sets[j], threshold)]
    top = roots(edges, range(len(ids)))
    groups = collections.defaultdict(list)
    for i, r in top.items():
        groups[r].append(ids[i])
    return {ids[i]: min(groups[r]) for i, r in top.items()}


def test_groups_equal_brute_force_on_edited_copies(spark):
    random.seed(9)
    rows, n = [], 0
    for _ in range(25):
        base = [f"w{random.randint(0, 3000)}" for _ in range(random.choice([30, 120, 400]))]
        for _copy in range(random.randint(1, 6)):
            text = list(base)
            for _edit in range(random.choice([0, 0, 1, 2, 5, 12])):
                text[random.randrange(len(text))] = f"e{random.randint(0, 99999)}"
            rows.append((n, " ".join(text)))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    idf = neardup.document_frequencies(docs)
    want = brute_groups([r[0] for r in rows], [r[1] for r in rows], idf)
    got = neardup.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["cluster_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["cluster_id"]) for r in got)
    sizes = collections.Counter(want.values())
    assert all(r["cluster_size"] == sizes[r["cluster_id"]] for r in got)


def test_samples_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    shingle = rng.integers(0, 2**44, 600, np.uint64)
    w = rng.random(600) + 0.5
    a, b = np.zeros(600), np.zeros(600)
    a[:500], b[100:] = w[:500], w[100:]
    sampler = neardup.Sampler(4000)
    sig = []
    for x in (a, b):
        keep = np.flatnonzero(x)
        keep = keep[np.argsort(shingle[keep])]
        sig.append(sampler.sample(np.array([0]), shingle[keep], x[keep])[0])
    assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_left_over_pairs_link_what_no_leader_does(spark, monkeypatch):
    """A chain: each text is similar to the next, but not to the bucket's leader."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(12):
        text = list(base)
        for e in range(k):
            text[15 * e] = f"edit{e}"
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(docs).collect()
    assert {r["cluster_id"] for r in got} == set(brute_groups([r[0] for r in rows], [r[1] for r in rows], neardup.document_frequencies(docs)).values()) == {0}


def test_neardup_on_awkward_and_empty(awkward, nothing):
    rows = neardup.near_duplicates(awkward).collect()
    assert len(rows) == 12
    by = collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert by[2][0]["cluster_id"] == 1 and not by[2][0]["kept"] and by[1][0]["kept"] and by[1][0]["cluster_size"] == 3
    assert by[3][0]["kept"] and by[4][0]["kept"] and by[5][0]["kept"] and by[None][0]["kept"]
    kept = neardup.keep_one(awkward)
    assert kept.columns == awkward.columns and kept.count() == 10
    twice = neardup.keep_one(awkward.where("doc_id = 2"))
    assert twice.count() == 1
    assert neardup.near_duplicates(nothing).count() == 0 and neardup.keep_one(nothing).count() == 0


def brute_vectors(rows):
    ok = {i: np.array(v, float) / np.linalg.norm(v) for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)}
    edges = [(i, j) for i in ok for j in ok if j < i and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= 0.95]
    return edges


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(60):
        base = rng.standard_normal(32)
        for _copy in range(rng.integers(1, 7)):
            v = base + rng.standard_normal(32) * rng.choice([0.0, 0.05, 0.2, 0.3])
            rows.append((len(rows), v.astype(np.float32).tolist()))
    rows += [(900, None), (901, []), (902, [0.0] * 32), (903, [1.0, None] + [0.0] * 30), (904, [float("nan")] * 32), (905, [1.0, 2.0]), (906, [2.0, 4.0]), (None, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as point", "2 as lists", "3 as n_links")
    edges = brute_vectors([r for r in rows])
    degree = collections.Counter(x for e in edges for x in e)
    top = roots(edges, range(len(rows)))
    members = collections.defaultdict(list)
    for i, r in top.items():
        members[r].append(rows[i][0])
    want = sorted(((rows[i][0], degree[i], min((x for x in members[top[i]] if x is not None), default=None)) for i in range(len(rows))), key=str)
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in vectors.near_vectors(df).collect()), key=str)
    assert got == want


def test_crowded_filters_are_dealt_in_tiles(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = rng.standard_normal(16)
    rows = [(i, (base + rng.standard_normal(16) * 0.01).tolist()) for i in range(90)] + [(100 + i, base.tolist()) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(vectors, "TILE", 16)
    got = vectors.near_vectors(df).collect()
    assert {r["n_links"] for r in got} == {94} and {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1
    assert vectors.near_vectors(df.where(F.lit(False))).count() == 0


def test_cap_plan_grows_with_the_vectors():
    few, many = vectors.plan_caps(1_000, 64), vectors.plan_caps(10_000_000, 64)
    assert many.words > few.words and many.height > few.height
    assert abs(vectors.upper_tail(vectors.cap_height(0.01, 64) * 8) - 0.01) < 1e-9


def plain_sets(rows):
    """Weighted shingle sets in plain Python, with exact document frequencies."""
    import math
    import re

    sets = []
    for _, text in rows:
        w = re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", "".join(c.lower() if c.isascii() else c for c in text or "")) or re.findall(r"[^\x20\x09-\x0D]+", text or "")
        sets.append(collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter())
    df = collections.Counter(k for s in sets for k in s)
    idf = {k: 1 + min(1.0, max(0.0, math.log(len(rows) / n) / math.log(1 / neardup.RARE))) for k, n in df.items()}
    return [{k: n * idf[k] for k, n in s.items()} for s in sets]


def test_recall_and_precision_against_plain_python(documents, spark):
    """Every pair of 0.8 or more by an independent measure, near copies among them: 0.9 of them at least are found."""
    from tests.conftest import SF01

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()]
    sets = plain_sets(rows)
    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for k in s:
            holders[k].append(i)
    pairs = {(a, b) for v in holders.values() for x, b in enumerate(v) for a in v[:x]}

    def similar(a, b):
        least = sum(min(w, sets[b][k]) for k, w in sets[a].items() if k in sets[b])
        return least / (sum(sets[a].values()) + sum(sets[b].values()) - least)

    score = {p: similar(*p) for p in pairs}
    group = {r["doc_id"]: r["cluster_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    together = lambda p: group[rows[p[0]][0]] == group[rows[p[1]][0]]
    near = [p for p, j in score.items() if 0.8 <= j < 0.999]
    same = [p for p, j in score.items() if j >= 0.999]
    assert len(near) > 10 and len(same) > 10
    assert all(map(together, same)) and sum(map(together, near)) >= 0.9 * len(near)
    # no document is alone with others that it is not near to: each member of a group has a partner of about 0.8 in it
    best = collections.defaultdict(float)
    for p, j in score.items():
        if together(p):
            for x in p:
                best[x] = max(best[x], j)
    sizes = collections.Counter(group.values())
    assert all(best[i] > 0.75 for i, r in enumerate(rows) if sizes[group[r[0]]] > 1)


def test_copies_in_other_case_and_punctuation_and_of_marks_alone(spark):
    base = " ".join(f"Word{k} x{k}." for k in range(30))
    rows = [(1, base), (2, base.lower().replace(".", ",")), (3, "!!! ### ~~~ !!! ###"), (4, "!!! ### ~~~ !!! ###"), (5, "--- ==="), (6, "")]
    got = {r["doc_id"]: (r["cluster_id"], r["kept"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True), 4: (3, False), 5: (5, True), 6: (6, True)}
