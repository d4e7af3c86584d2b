"""Whole-number token buckets, rules by automaton, seen ids across batches, deep pages, zone map, gateway."""

import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftlog import fixtures as fx
from driftlog.operators import alerts
from driftlog.operators.alerts import match_rules
from driftlog.operators.bucketmaps import Bucket, Map, throttle_exact
from driftlog.operators.dedup import dedup_ttl
from driftlog.operators.gateway import gateway
from driftlog.operators.paging import page_at
from driftlog.operators.patterns import found_needles
from driftlog.operators.search import SearchRequest, order_columns, search
from driftlog.operators.seen import SeenIds
from driftlog.operators.throttle import throttle
from driftlog.plans.catalog import normalised_entries
from driftlog.schemas import API_KEY, LOG_ENTRY, RULE
from driftlog.sources.archive import archive, index_archive, overlapping, read_archive
from tests.conftest import SF001
from tests.helpers import T0, at, entry

# ---- token buckets


def one_by_one(bucket, gains, x):
    admitted, left = [], []
    for g in gains.tolist():
        x, ok = bucket.one(x, g)
        admitted.append(ok)
        left.append(x)
    return admitted, left, x


def loads(rng, rps, n):
    mean = 1e6 / rps
    return np.array(rng.choice([
        lambda: [int(rng.random() * mean * 0.9) for _ in range(n)],  # overload throughout
        lambda: [int(rng.expovariate(1 / mean)) for _ in range(n)],
        lambda: [int(rng.choice([0.5, 0.99, 1, 1.3]) * mean) for _ in range(n)],
        lambda: [x for _ in range(n // 40 + 1) for x in [int(rng.random() * mean)] * 25 + [int(mean * rng.uniform(1, 3))] * 15][:n],
    ])(), np.int64)


def test_folds_and_maps_equal_the_sequential_bucket():
    rng = random.Random(3)
    for _ in range(250):
        bucket = Bucket(rng.choice([0.5, 1, 1.5, 2, 3, 10, 40]))
        gains = bucket.gain(loads(rng, bucket.rate, rng.randint(0, 250)))
        m, cut = Map(bucket), rng.randint(0, len(gains))
        m.then(gains[:cut])
        m.then(gains[cut:])
        edges = [x for lo in m.lo.tolist()[:20] for x in (lo - 1, lo) if 0 <= x <= bucket.full]
        for x in {0, bucket.full, *edges, *(rng.randint(0, bucket.full) for _ in range(4))}:
            admitted, left, end = one_by_one(bucket, gains, x)
            got = bucket.fold(gains, x)
            assert (got[0].tolist(), got[1].tolist(), got[2]) == (admitted, left, end) and m(x) == end


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_throttle_over_partitions(spark, parts):
    rng = random.Random(9)
    rows, want = [], {}
    for tenant, rps_share in (("busy", 4.0), ("calm", 0.3), (None, 1.1)):
        bucket, x, last, t = Bucket(10), None, None, 0
        for k in range(400):
            t += int(rng.expovariate(10 * rps_share / 1e6))
            name = f"{tenant}-{k:03d}"
            rows.append((name, tenant, T0 + timedelta(microseconds=t)))
            x, want[name] = bucket.one(bucket.full if x is None else x, 0 if x is None else int(bucket.gain(np.int64(t - last))))
            last = t
    rows.append(("untimed", "busy", None))
    df = spark.createDataFrame(rows, "request_id string, tenant_id string, ts timestamp")
    got = {r["request_id"]: r["admitted"] for r in throttle_exact(df, 10, order=["request_id"], num_partitions=parts).collect()}
    assert got.pop("untimed") and got == want
    assert throttle_exact(df.limit(0), 10).count() == 0


def test_exact_and_float_buckets_agree_away_from_ties(spark):
    rng = random.Random(4)
    rows = [(f"{k:04d}", "t", T0 + timedelta(microseconds=rng.randrange(10**8))) for k in range(600)]
    df = spark.createDataFrame(rows, "request_id string, tenant_id string, ts timestamp")
    a, b = ({r["request_id"]: r["admitted"] for r in f(df, 3, order=["request_id"]).collect()} for f in (throttle_exact, throttle))
    assert a == b


# ---- rules


def rules_frame(spark, rules):
    return spark.createDataFrame([(*r, 1, 60, "") for r in rules], RULE)


def test_many_rules_match_like_few(spark, monkeypatch):
    rng = random.Random(2)
    words = ["disk", "Full", "k=1", "k=12", "é", "", "net", "İx", "ß"]
    rows = [entry(f"{k}", tenant_id=rng.choice(["t1", "t2", "*", ""]), level=rng.choice(["ERROR", "warn", ""]), message=" ".join(rng.choices(words, k=3))) for k in range(150)]
    rows.append(entry("none", tenant_id="t1", message=None))
    rules = rules_frame(spark, [(f"r{k}", rng.choice(["*", "t1", "t2", "t3", ""]), rng.choice(["", "Error", "WARN"]), rng.choice([*words, "disk full", None])) for k in range(120)])
    entries = spark.createDataFrame(rows, LOG_ENTRY)
    many = sorted((r.rule, r.log_id) for r in match_rules(entries, rules).collect())
    monkeypatch.setattr(alerts, "MAX_BROADCAST_RULES", 10)
    joined = sorted((r.rule, r.log_id) for r in match_rules(entries, rules).collect())
    monkeypatch.setattr(alerts, "MAX_BROADCAST_RULES", 5_000)
    monkeypatch.setattr(alerts, "FEW_RULES", 1_000)
    few = sorted((r.rule, r.log_id) for r in match_rules(entries, rules).collect())
    assert many == few == joined and len(few) > 100


def test_needles_in_slices(spark, monkeypatch):
    from driftlog.operators import patterns

    entries = spark.createDataFrame([("t1", "abcab"), ("t2", "bc"), (None, "abc"), ("t1", None)], "tenant string, msg string")
    needles = spark.createDataFrame([(1, "t1", "ab"), (2, "*", "bc"), (3, "t2", "c"), (4, "*", ""), (5, "t1", "zz")], "id long, tenant string, needle string")
    run = lambda: sorted(map(str, (tuple(r) for r in found_needles(entries, needles, "tenant", "msg", "id").collect())))
    whole = run()
    monkeypatch.setattr(patterns, "MAX_NEEDLE_CHARS", 20)
    assert run() == whole and len(whole) == 8


def test_many_rules_plan_has_no_nested_loop(spark):
    plan = match_rules(normalised_entries(spark, SF001), fx.many_rules(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("FileScan") <= 3


# ---- seen ids


def test_runs_remember_ids_until_they_expire(spark, tmp_path):
    seen = SeenIds(spark, str(tmp_path / "seen"), 300)
    run = lambda k, *s: sorted(r.message for r in seen.dedup(spark.createDataFrame([entry(i, message=f"{i}{t}", ingest=at(t)) for i, t in s], LOG_ENTRY), k).collect())
    assert run(0, ("a", 0), ("a", 10), ("b", 0), ("", 0), ("", 0)) == ["0", "0", "a0", "b0"]
    assert run(1, ("a", 100)) == []
    assert run(1, ("a", 100)) == []  # the same batch again
    assert run(2, ("a", 300), ("b", 400)) == ["a300", "b400"]  # a's time is over exactly at first sight + 300
    assert run(3, ("a", 599), ("b", 700)) == ["b700"]  # from 300 on the time runs anew
    assert run(4, ("", 800)) == ["800"] and run(5) == []
    seen.forget((int(T0.timestamp()) + 10**6) * 10**6)
    assert seen.live(0, 99).count() == 0


def test_batches_by_time_equal_one_batch(spark, tmp_path):
    rows = normalised_entries(spark, SF001)
    want = sorted((r.log_id, r.shift, r.event_id) for r in dedup_ttl(rows, 300, order=["log_id", "shift"]).collect())
    times = [r[0] for r in rows.select(F.unix_micros("ingest_timestamp")).orderBy(F.unix_micros("ingest_timestamp")).collect()]
    rng, got = random.Random(7), []
    cuts = [times[0], *sorted(rng.sample(times, 2)), times[-1] + 1]
    seen = SeenIds(spark, str(tmp_path / "seen"), 300)
    for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        part = rows.where((F.unix_micros("ingest_timestamp") >= lo) & (F.unix_micros("ingest_timestamp") < hi))
        got += [(r.log_id, r.shift, r.event_id) for r in seen.dedup(part, k, order=["log_id", "shift"]).collect()]
    assert sorted(got) == want


# ---- deep pages


def test_pages_by_selection_equal_the_sorted_list(spark):
    rng = random.Random(1)
    rows = [entry(f"{k:04d}", tenant_id="t", event=None if k % 50 == 0 else at(rng.choice([5, 5, 5, 6, 7, rng.randrange(10**6)])), ingest=at(rng.choice([1, 1, 2]))) for k in range(1500)]
    df = spark.createDataFrame(rows, LOG_ENTRY)
    keys = [F.unix_micros("event_timestamp"), F.unix_micros("ingest_timestamp")]
    whole = [r.log_id for r in df.orderBy(*order_columns()).collect()]
    for offset, size, most in ((0, 10, 50), (700, 40, 50), (900, 300, 100), (1490, 100, 20), (1500, 5, 20), (10**12, 5, 20), (400, 1000, 10)):
        assert [r.log_id for r in page_at(df, keys, order_columns(), offset, size, most).collect()] == whole[offset : offset + size]


def test_page_a_million(spark):
    """Page 1,000,000: an offset beyond any top-k, over rows of which thousands tie."""
    at_ = F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") % 5_000 * 1_000)
    table = spark.range(1_000_050).select(
        F.lpad(F.col("id").cast("string"), 8, "0").alias("log_id"), F.lit("t").alias("tenant_id"),
        *[F.lit("").alias(c) for c in ("service", "host", "container", "environment", "level", "message", "trace_id", "request_id")],
        at_.alias("event_timestamp"), at_.alias("ingest_timestamp"), F.create_map().cast("map<string,string>").alias("fields"))
    req = SearchRequest("t", from_ts=at(-10), to_ts=at(10**6), page=1_000_000, page_size=1)
    page, total = search(table, req)
    rank = lambda i: (4_999 - i % 5_000, i)  # noqa: E731  the largest time first, then the id
    want = sorted(range(1_000_050), key=rank)[999_999]
    assert [r.log_id for r in page.collect()] == [f"{want:08d}"] and total.get["total"] == 1_000_050
    assert search(table, SearchRequest("t", from_ts=at(-10), to_ts=at(10**6), page=2**40, page_size=1000))[0].count() == 0


# ---- archive


def test_only_objects_with_the_hour_are_opened(spark, tmp_path):
    path = str(tmp_path / "cold")
    late = [entry("late", tenant_id="t1", event=at(30), ingest=at(9 * 3600))]  # written nine hours after its time
    rows = [entry(f"{h}-{m}", tenant_id="t1", event=at(h * 3600 + m * 60), ingest=at(h * 3600 + m * 60)) for h in range(6) for m in range(0, 60, 20)]
    none = [entry("untimed", tenant_id="t1", event=None, ingest=at(20 * 3600))]
    archive(spark.createDataFrame(rows + late + none, LOG_ENTRY), path, F.date_trunc("hour", "ingest_timestamp"))
    assert index_archive(spark, path) == 8 and index_archive(spark, path) == 0
    lo, hi = at(0), at(3599)
    opened = overlapping(spark, path, "t1", lo, hi)
    assert sorted(p.split("hh=")[1][:2] for p in opened) == ["00", "09"]
    inside = lambda df: sorted(r.log_id for r in df.where(F.col("event_timestamp").between(F.lit(lo), F.lit(hi))).collect())
    assert inside(read_archive(spark, path, "t1", lo, hi)) == inside(read_archive(spark, path, "t1")) == ["0-0", "0-20", "0-40", "late"]
    archive(spark.createDataFrame([entry("new", tenant_id="t1", event=at(60), ingest=at(3 * 86_400))], LOG_ENTRY), path, F.date_trunc("hour", "ingest_timestamp"))
    assert "new" in inside(read_archive(spark, path, "t1", lo, hi))  # not indexed yet: opened
    assert index_archive(spark, path) == 1 and read_archive(spark, path, "t2", lo, hi).count() == 0


# ---- gateway


def test_gateway_order_and_answers(spark):
    body = '{"entries":[{"log_id":"1","tenant_id":"forged","service":"api","message":"m"},{"service":"other"}]}'
    rows = [("r0", "t1", "bad", 0, body), ("r1", "t1", "k1", 0, body), ("r2", "t1", "k1", 1, '{"entries":['), ("r3", "t1", "k1", 2, body),
            ("r4", "", "k1", 3, body), ("r5", "t2", "k2", 0, '{"entries":[]}'), ("r6", "t2", "k2", 600, None), ("r7", "t2", "k2", 2_000, "x" * 50)]
    rows = [(i, t, k, T0 + timedelta(milliseconds=ms), b) for i, t, k, ms, b in rows]
    df = spark.createDataFrame(rows, "request_id string, tenant_id string, api_key string, ts timestamp, body string")
    keys = spark.createDataFrame([("t1", "k1"), ("t2", "k2")], API_KEY)
    responses, messages = gateway(df, keys, 2, max_bytes=1_000)
    assert {r.request_id: r.status for r in responses.collect()} == {"r0": 401, "r1": 202, "r2": 400, "r3": 429, "r4": 401, "r5": 202, "r6": 400, "r7": 400}
    got = sorted((r.call_id, r.key, r.position, r.tenant_id, r.service, str(r.ingest_timestamp)) for r in messages.collect())
    assert [g[:5] for g in got] == [("r1", "t1|api", 0, "t1", "api"), ("r1", "t1|api", 1, "t1", "other")] and got[0][5].startswith("2024-01-01 00:00:00")
    small, _ = gateway(df, keys, 2, max_bytes=20)
    assert {r.request_id: r.status for r in small.collect()}["r1"] == 400


def test_gateway_reads_a_body_once(spark):
    body = '{"entries":[{"service":"a","message":null,"fields":{"k":null}},null]}'
    df = spark.createDataFrame([("r1", "t", "k", T0, body), ("r2", "t", "k", T0, body[:-2])], "request_id string, tenant_id string, api_key string, ts timestamp, body string")
    responses, messages = gateway(df, spark.createDataFrame([("t", "k")], API_KEY), 5)
    assert {r.request_id: r.status for r in responses.collect()} == {"r1": 202, "r2": 400}
    assert sorted((r.call_id, r.position, r.key, r.service, r.message, r.fields) for r in messages.collect()) == [("r1", 0, "t|a", "a", "", {"k": ""}), ("r1", 1, "t|a", "", "", {})]
    assert "parsejson" not in messages._jdf.queryExecution().optimizedPlan().toString().lower().replace("_", "")
