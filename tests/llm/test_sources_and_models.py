import collections
import math
import zlib

import duckdb
import numpy as np
import pytest

from driftlog.llm import langmodel, mixing, oracles, secrets, urls
from tests.conftest import SF01
from tests.llm.conftest import SF, words

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def same_as_sql(frame, sql, **tables):
    c = duckdb.connect()
    for name, df in tables.items():
        data = df.toArrow()  # noqa: F841
        c.register(name, data)
    got = frame.toArrow()
    want = c.sql(sql).to_arrow_table().select(got.column_names)
    key = lambda t: sorted(map(str, zip(*(x.to_pylist() for x in t.columns), strict=True)))
    assert key(got) == key(want)


def test_mix_equals_sql(documents, awkward):
    same_as_sql(mixing.taken(documents), oracles.OP5, documents=documents)
    same_as_sql(mixing.taken(awkward.where("doc_id <> 2")), oracles.OP5, documents=awkward.where("doc_id <> 2"))


def test_mix_meets_targets_and_caps(documents):
    rows = mixing.taken(documents).collect()
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    per = collections.defaultdict(int)
    for r in rows:
        per[(r["source_size"], r["target"])] += r["taken"]
    assert all(abs(t - target) <= mixing.BLOCK_WORDS for (_, target), t in per.items())


def test_targets_are_shared_by_weight_up_to_the_cap(spark):
    rows = [("a", 10), ("b", 1000), ("c", 1000), (None, 50), ("d", 0)]
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    size, weight = dict(rows), {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    want, left, open_ = {}, 2060.0, set(size)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 3 * size[s]}
        if not over:
            break
        for s in over:
            want[s] = 3.0 * size[s]
            left -= want[s]
        open_ -= over
    want |= share
    assert all(math.isclose(got[s], want[s]) for s in size)


def test_permutations_are_bijections(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 100):
        got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit("k"))).collect()]
        assert sorted(got) == list(range(n))


def test_mixed_documents_hold_what_was_taken(documents, awkward, nothing):
    taken = collections.Counter()
    for r in mixing.taken(documents).collect():
        taken[r["doc_id"]] += r["taken"]
    out = mixing.mixed_documents(documents)
    assert out.columns == documents.columns
    got = collections.Counter()
    for r in out.collect():
        got[r["doc_id"]] += len(words(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert got == collections.Counter({k: v for k, v in taken.items() if v})
    mixed = mixing.mixed_documents(awkward)
    assert mixed.columns == awkward.columns and {r["doc_id"] for r in mixed.select("doc_id").collect()}.isdisjoint({3, 4, 5})
    assert mixing.mixed_documents(nothing).count() == mixing.taken(nothing).count() == 0
    blocks = mixing.mixed_blocks(documents)
    assert blocks.selectExpr("sum(size(split(text, ' ')))").collect()[0][0] == sum(taken.values())


PAGES = [
    (1, "https://A.Example.NET/en/x?q", '<a href="//x.other.com/z">'), (2, "http://blog.example.com/de/1", None), (3, "http://m.example.com", ""),
    (4, None, "<a href='http://m.example.com/'>"), (5, "no scheme", ""), (6, "http://shop.example.org/fr/1#t", "<a href=https://blog.example.com/de/ src='//m.example.com'>"),
    (7, "https://x.net", ""), (8, "https://x.net/", ""), (9, "ftp://z.example.com/en/", '<a href="//blog.example.com">'), (9, "ftp://z.example.com/en/", '<a href="//blog.example.com">'),
    (None, "http://lonely/", ""), (11, "http://", ""),
]


def test_urls_equal_sql(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    same_as_sql(urls.url_filter(pages), oracles.OP3, pages=pages)
    given = spark.read.parquet(f"{SF}/pages.parquet")
    same_as_sql(urls.url_filter(given), oracles.OP3, pages=given)


def test_url_verdicts(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as host", "'p' as path", "2 as trust")
    rows = {r["page_id"]: r for r in urls.url_filter(pages).collect()}
    assert (rows[1]["host"], rows[1]["path"], rows[1]["rule"], rows[1]["verdict"]) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert rows[2]["rule"] == "example.com/de/" and rows[2]["verdict"] == "block" and rows[6]["rule"] == "org/fr/"
    assert rows[7]["rule"] is None and rows[8]["rule"] == "net/"  # the rule's path is '/', an empty path does not start with it
    assert rows[4]["host"] == "" and rows[4]["verdict"] == rows[5]["verdict"] == rows[None]["verdict"] == "allow"
    assert rows[9]["distrust"] > rows[9]["trust"] and rows[9]["verdict"] == "block"  # it links to a blocked host
    assert urls.url_filter(pages.where("page_id = 99")).count() == 0


def test_small_seeds_of_large_tables_keep_a_score(spark):
    out = 31
    edges = [("seed", f"h{k}", 1) for k in range(out)] + [("h0", f"g{k}", 1) for k in range(out)] + [("bad", f"b{k}", 1) for k in range(out)]
    edges += [("x", "b0", 1), ("x", "h0", 1), ("x", "h1", 1), ("x", "h2", 1)]
    edges = spark.createDataFrame(edges, "src string, dst string, n long")
    seeds = spark.createDataFrame([("big", 0, 10**7), ("seed", 0, 1), ("big", 1, 10**9), ("b0", 1, 1)], "host string, kind int, n long")
    got = {r["host"]: r for r in urls.spread(edges, seeds).collect()}
    assert math.isclose(got["h1"]["trust"], urls.MASS / (10**7 + 1) * 0.15 * 0.85 / out, rel_tol=1e-9)
    assert math.isclose(got["g3"]["trust"], urls.MASS / (10**7 + 1) * 0.15 * (0.85 / out) ** 2, rel_tol=1e-9)
    assert got["bad"]["distrust"] > 0 and got["x"]["distrust"] > got["x"]["trust"] == 0
    assert {h: (int(r["trust"]), int(r["distrust"])) for h, r in got.items()} == spread_in_python(edges.collect(), seeds.collect())


def spread_in_python(edges, seeds):
    score = {}
    for kind in (0, 1):
        links = collections.Counter()
        for e in edges:
            links[(e["src"], e["dst"]) if kind == 0 else (e["dst"], e["src"])] += e["n"]
        out, total = collections.Counter(), sum(s["n"] for s in seeds if s["kind"] == kind)
        for (src, _), n in links.items():
            out[src] += n
        rank = {s["host"]: urls.MASS * s["n"] // total for s in seeds if s["kind"] == kind}
        rest = {h: m * (100 - urls.DAMPING) // 100 for h, m in rank.items()}
        for _ in range(urls.STEPS):
            new = collections.Counter(rest)
            for (src, dst), n in links.items():
                if src in rank:
                    new[dst] += rank[src] * n // out[src] * urls.DAMPING // 100
            rank = dict(new)
        for h, m in rank.items():
            score.setdefault(h, [0, 0])[kind] = m
    return {h: tuple(m) for h, m in score.items()}


def test_deep_weak_links_equal_sql(spark):
    """Many seeded pages, and four hops over hosts with 60 to 100 links each."""
    far = [f"h{k}.far.io" for k in range(100)]
    link = lambda hosts: "".join(f'<a href="//{h}/x">' for h in hosts)
    pages = [(k, f"http://s{k % 7}.org/fr/{k}", link(far[:60])) for k in range(200)] + [(300 + k, f"http://b{k % 5}.net/{k}", link(far[40:])) for k in range(200)]
    pages += [(600 + k, f"http://{h}/p", link(f"g{j}.deep.io" for j in range(k % 40, k % 40 + 60))) for k, h in enumerate(far)]
    pages += [(800 + k, f"http://g{k}.deep.io/p", link(f"e{j}.end.io" for j in range(80))) for k in range(100)] + [(999, "http://e5.end.io/q", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    same_as_sql(urls.url_filter(df), oracles.OP3, pages=df)


def lm_truth(docs):
    texts = [(r["doc_id"], [w.translate(FOLD) for w in words(r["text"])] + [None]) for r in docs]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    one = collections.Counter(w for i, t in texts if not held(i) for w in t)
    two = collections.Counter(p for i, t in texts if not held(i) for p in zip([None, *t[:-1]], t, strict=True))
    n, v = sum(one.values()), len(one)
    for i, t in texts:
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t)
        lam = langmodel.LAMBDA
        score = sum(math.log10(lam * max(two[h, w] - langmodel.DISCOUNT, 0) / max(one[h], 1) + (1 - lam) * (one[w] + 1) / (n + v + 1)) for h, w in zip([None, *t[:-1]], t, strict=True))
        yield i, held(i), len(t), sum(one[w] > 0 for w in t), n, base, score


@pytest.mark.parametrize("split", [False, True])
def test_lm_scores(documents, awkward, monkeypatch, split):
    if split:  # several banks, and the exact table joined by shuffle
        monkeypatch.setattr(langmodel, "BANK_BITS", langmodel.SEGMENT_BITS)
    for df in (documents, awkward.where("doc_id <> 2 or doc_id is null")):
        out = langmodel.lm_scores(df, max_exact=10 if split else langmodel.MAX_EXACT)
        got = sorted(out.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
        want = sorted(lm_truth(df.select("doc_id", "text").collect()), key=lambda r: (r[0] is None, r[0]))
        assert [tuple(g)[:5] for g in got] == [w[:5] for w in want]
        for g, w in zip(got, want, strict=True):
            assert math.isclose(g["base_score"], w[5], rel_tol=1e-9) and abs(g["score"] - w[6]) < 0.35 * w[2] + 0.5


@pytest.mark.parametrize("max_exact", [10, langmodel.MAX_EXACT])
def test_lm_counts_do_not_fade_with_the_vocabulary(spark, monkeypatch, max_exact):
    monkeypatch.setattr(langmodel, "ONE_BITS", langmodel.SEGMENT_BITS, raising=False)  # the bound there was
    per, held = 25_000, next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 7 == 2)
    learn = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 != 2][:40]
    texts = [(i, " ".join(f"w{i}x{k}" for k in range(per))) for i in learn] + [(held, " ".join(f"new{k}" for k in range(2_000)))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r for r in langmodel.lm_scores(docs, max_exact=max_exact).collect()}[held]
    n, v, lam = len(learn) * (per + 1), len(learn) * per + 1, langmodel.LAMBDA
    unknown = math.log10((1 - lam) / (n + v + 1))
    assert got["train_tokens"] == n and got["n_known"] == 1 and got["n_tokens"] == 2_001
    assert abs(got["score"] - 2_000 * unknown) < 25  # 2,000 tokens without a count, of about -6.5 each


def test_lm_past_one_bank_moves_no_text_and_scores_once(documents, monkeypatch):
    want = {r["doc_id"]: r for r in langmodel.lm_scores(documents, max_exact=10).collect()}
    build, cut, cuts = langmodel.build_filter, langmodel.cut, []
    monkeypatch.setattr(langmodel, "build_filter", lambda counted, entries: build(counted, entries * 40))  # 5 segments or more
    monkeypatch.setattr(langmodel, "cut", lambda df: cuts.append(df.columns) or cut(df))
    monkeypatch.setattr(langmodel, "BANK_BITS", langmodel.SEGMENT_BITS)
    monkeypatch.setattr(langmodel, "EXACT_BANK", 3_000, raising=False)
    rows = langmodel.lm_scores(documents, max_exact=10).collect()
    assert not any({"text", "levels", "tf"} & set(c) for c in cuts) and sum("score" in c for c in cuts) == 1
    for r in rows:
        w = want[r["doc_id"]]
        assert tuple(r)[:5] == tuple(w)[:5] and math.isclose(r["base_score"], w["base_score"], rel_tol=1e-9)
        assert abs(r["score"] - w["score"]) < 0.05 * r["n_tokens"]
    cuts.clear()
    monkeypatch.setattr(langmodel, "PASS_BANKS", 2, raising=False)
    again = {r["doc_id"]: r for r in langmodel.lm_scores(documents, max_exact=10).collect()}
    assert sum("score" in c for c in cuts) > 1
    for r in rows:
        w = again[r["doc_id"]]
        assert tuple(r)[:5] == tuple(w)[:5] and math.isclose(r["score"], w["score"], rel_tol=1e-9)


def test_workers_map_a_shared_array(spark):
    import pyarrow as pa

    from driftlog.llm.common import Shared

    arrays = [np.arange(200_000, dtype=np.uint64) << np.uint64(40), np.arange(70_001, dtype=np.uint8), np.arange(3), np.empty(0, np.int64)]
    shared = [Shared(spark, a) for a in arrays]

    def run(batches):
        for b in batches:
            sums = [int(x.array().astype(np.uint64).sum()) for x in shared]
            maps = [isinstance(x.array(), np.memmap) for x in shared]
            yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.int64())), pa.array([maps])], ["sums", "maps"])

    row = spark.range(1, numPartitions=1).mapInArrow(run, "sums array<long>, maps array<boolean>").collect()[0]
    assert row["sums"] == [int(a.astype(np.uint64).sum()) for a in arrays] and row["maps"][:2] == [True, True]
    for x, a in zip(shared, arrays, strict=True):
        x._mapped = lambda: None  # a broadcast without such a file is loaded
        assert (x.array() == a).all()
        x.destroy()


def test_texts_that_stand_twice_score_apart(spark):
    """Training texts that occur twice against those that occur once, by score per token over the unigram's."""
    rng = np.random.default_rng(6)
    text = lambda: " ".join(f"w{k}" for k in rng.integers(0, 3_000, 120))
    ids = [i for i in range(2_000) if zlib.crc32(str(i).encode()) % 7 != 2][:600]
    texts = {i: text() for i in ids}
    twice = set(ids[:40]) | set(ids[40:80])
    for a, b in zip(ids[:40], ids[40:80], strict=True):
        texts[b] = texts[a]
    rows = langmodel.lm_scores(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    gain = {r["doc_id"]: (r["score"] - r["base_score"]) / r["n_tokens"] for r in rows}
    bar = np.quantile([gain[i] for i in ids if i not in twice], 0.95)
    assert np.mean([gain[i] > bar for i in twice]) >= 0.9


def test_lm_on_empty(nothing):
    assert langmodel.lm_scores(nothing).count() == 0


def test_filter_levels():
    rng = np.random.default_rng(2)
    key = rng.integers(0, 2**63, 20_000, np.uint64)
    count = rng.integers(1, 300, 20_000)
    f = langmodel.Filter(1, 0, np.frombuffer(langmodel.build_segment(key, count), np.uint8))
    level = f.levels(key)
    assert (level >= 1 + np.floor(np.log2(count))).all()  # an error only raises a count
    assert (level == 1 + np.floor(np.log2(count))).mean() > 0.99
    assert (f.levels(rng.integers(0, 2**63, 20_000, np.uint64)) > 0).mean() < 0.01


def test_secrets(spark, awkward, nothing, documents):
    rows = secrets.scan(documents.unionByName(awkward.select(documents.columns))).collect()
    by = {(r["doc_id"], r["value"]): r for r in rows}
    assert by[7, "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567"]["secret"]
    assert not by[10, "mail7.example.com"]["secret"] and not by[10, "4845168114407329"]["secret"]
    assert by[10, "mail7.example.com"]["start"] == 5
    clean = secrets.redact(documents.unionByName(awkward.select(documents.columns)))
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert clean.columns == documents.columns and texts[7] == 'say token = "[SECRET]" now' and "mail7" in texts[10]
    alone = secrets.scan(awkward).collect()  # one labelled secret against two others is enough to train on
    assert {r["doc_id"] for r in alone} == {7, 10}
    assert all(r["score"] == 1.0 for r in secrets.scan(awkward.where("doc_id = 7")).collect())
    assert secrets.scan(nothing).count() == 0 and secrets.redact(nothing).count() == 0
    assert secrets.redact(awkward).count() == 12


def test_secrets_are_judged_at_every_place(spark, documents):
    key = "00a1b2c3d4e5f60718293a4b5c6d7e8f90123456"
    text = f'éé see http://host7.example.org/{key}/x {key}x and https://y.example.org {key} then token = "{key}" end {key}'
    more = spark.createDataFrame([(-1, text, "en", "s1", len(text))], documents.schema)
    rows = [r for r in secrets.scan(documents.unionByName(more)).collect() if r["doc_id"] == -1]
    assert all(text[r["start"] : r["start"] + r["length"]] == r["value"] for r in rows)
    mine = sorted((r for r in rows if r["value"] == key), key=lambda r: r["start"])
    first = text.index(f" {key} then") + 1  # not the one inside a longer run
    assert [r["start"] for r in mine] == [first, text.index(f'"{key}"') + 1, text.rindex(key)]
    assert all(r["secret"] for r in mine) and mine[1]["score"] >= secrets.THRESHOLD
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(documents.unionByName(more)).collect()}[-1]
    assert key not in clean


def test_short_and_unusual_secrets_are_candidates(spark, documents):
    letters = "QwErTyUiOpAsDfGhJkLzXcVbNmqWeRtYuIoPaSdF"
    key = "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567"
    cases = {
        -1: ('so password = "hunter2x" it is', "hunter2x"), -2: (f'and token = "{letters}" here', letters), -3: ("pwd: P@ss!w0rd?x, then", "P@ss!w0rd?x"),
        -4: (f"see {'-' * 5_000}{key} end", key), -5: ("api_key='my 4 word pass phrase' ok", "my 4 word pass phrase"), -6: (f"bare {letters} end", letters),
    }
    prose = "wonderful instruments, and internationalization matters ---------------------- much"
    rows = [(i, t, "en", "s1", len(t)) for i, (t, _) in cases.items()] + [(-9, prose, "en", "s1", len(prose))]
    more = spark.createDataFrame(rows, documents.schema)
    found = {(r["doc_id"], r["value"]) for r in secrets.findings(more).collect()}
    assert {(i, v) for i, (_, v) in cases.items()} <= found
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(documents.unionByName(more)).collect()}
    for i in (-1, -2, -3, -5):
        assert clean[i] == cases[i][0].replace(cases[i][1], "[SECRET]")
    assert clean[-9] == prose


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    given = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, given, SF)
        assert out.columns == docs.columns, name
        given = spark.createDataFrame(out.toArrow())
        ids = {r["doc_id"] for r in given.select("doc_id").collect()}
        if name in ("toxicity", "minhash_neardup"):
            assert len(ids) <= n
            n = len(ids)
        if name == "secret_scan":
            assert len(ids) == n and given.where("text rlike 'token = \"[0-9a-f]{40}\"'").count() == 0
    last = corpus_pipeline.run(spark, SF)
    assert last.count() == given.count() and last.where("not lossless").count() == 0


@pytest.fixture(scope="module")
def searched(spark):
    """A session in which a query has been observed: from then on its objects cannot be sent to tasks."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    seen = Observation("seen")
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 3
    from driftlog.plans.catalog import q_search_one

    q_search_one(spark, SF01).collect()
    return spark


def test_secrets_and_pipeline_after_a_search(searched):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from driftlog.llm import queries

    assert queries.op8_secret_scan(searched, SF01).count() > 0
    assert corpus_pipeline.run(searched, SF01).count() > 0


CLASHES = ["'a' as _id", "'b' as _key", "1 as _row", "2 as _size", "3 as cluster_size", "'c' as _values", "4 as _nth", "'d' as _text", "5 as _same", "'e' as _text_key", "'f' as _doc_id", "'g' as _parts"]


def test_stages_keep_columns_that_are_named_like_their_own(awkward, nothing):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    spark = awkward.sparkSession
    for given in (awkward.selectExpr("*", *CLASHES), nothing.selectExpr("*", *CLASHES)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, given, SF)
            assert out.columns == given.columns
            rows = out.select("_id", "_key", "_row", "_size", "cluster_size", "_values").distinct().collect()
            assert [tuple(r) for r in rows] in ([("a", "b", 1, 2, 3, "c")], [])
            given = spark.createDataFrame(out.toArrow(), out.schema) if not out.isEmpty() else spark.createDataFrame([], out.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, given, SF).count() == given.count()


def test_entry_registers_the_queries():
    import __spark_entry__ as e

    names = list(e.queries())
    assert [x for x in names if x.startswith("op")] == [x for x in names if x.startswith("op")] and {f"op{n}_" for n in range(1, 14)} == {x.split("_")[0] + "_" for x in names if x.startswith("op")}
    assert "pipeline" in names and "log_pipeline" in names
