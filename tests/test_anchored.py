"""The anchored fold against a plain sequential fold, on random data and on edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftlog.operators.anchored import anchored_windows, fold_anchored


def brute(rows, after):
    """rows: (key, t, w, tie) -> {(key, tie): (anchor, ordinal)} by a row-at-a-time fold."""
    out, state = {}, {}
    for key, t, w, tie in sorted(rows, key=lambda r: (r[0], r[1], r[3])):
        st = state.get(key)
        new = st is None or (t > st[1] if after else t >= st[1])
        if new:
            st = [t, t + w, 0]
            state[key] = st
        st[2] += 1
        out[(key, tie)] = (st[0], st[2])
    return out


@pytest.mark.parametrize("after", [True, False])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_matches_brute_force_numpy(after, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(3000):
        key = rnd.choice("abcde")
        t = rnd.choice([rnd.randrange(0, 5000), rnd.randrange(0, 50) * 100])  # plenty of ties
        w = rnd.choice([100, 100, 250]) if seed == 3 else 100
        rows.append((key, t, w, i))
    rows.sort(key=lambda r: (r[0], r[1], r[3]))
    want = brute(rows, after)
    # feed in uneven slices to exercise the carried state
    got, carry, prev = {}, None, None
    cuts = sorted(rnd.sample(range(1, len(rows)), 40)) + [len(rows)]
    start = 0
    for end in cuts:
        part = rows[start:end]
        keys = [r[0] for r in part]
        ks = np.array([True] + [keys[i] != keys[i - 1] for i in range(1, len(keys))])
        ks[0] = prev is None or keys[0] != prev
        t = np.array([r[1] for r in part], dtype=np.int64)
        w = np.array([r[2] for r in part], dtype=np.int64)
        a, o, carry = fold_anchored(t, w, ks, after, carry if prev is not None else None)
        for r, aa, oo in zip(part, a, o):
            got[(r[0], r[3])] = (int(aa), int(oo))
        prev = keys[-1]
        start = end
    assert got == want


def test_spark_fold_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["k1", "k2", "k3"]), rnd.randrange(0, 20_000) * 1000, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, us long, tie long").withColumn("ts", F.timestamp_micros("us"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")  # many batches per key
    try:
        out = anchored_windows(df, ["k"], "ts", 0.3, boundary="after", order=["tie"]).select(
            "k", "tie", F.unix_micros("window_start").alias("a"), "ordinal").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute([(k, us, 300_000, tie) for k, us, tie in rows], after=True)
    assert {(r.k, r.tie): (r.a, r.ordinal) for r in out} == want


def test_boundary_exactly_at_end(spark):
    df = spark.createDataFrame([("k", 0), ("k", 10), ("k", 11)], "k string, s long").withColumn(
        "ts", F.timestamp_seconds("s"))
    after = anchored_windows(df, ["k"], "ts", 10, boundary="after").orderBy("s").collect()
    assert [r.ordinal for r in after] == [1, 2, 1]       # t = end still counts in the old window
    ttl = anchored_windows(df, ["k"], "ts", 10, boundary="at_or_after").orderBy("s").collect()
    assert [r.ordinal for r in ttl] == [1, 1, 2]         # t = first + TTL is new


def test_null_time_passes_through(spark):
    df = spark.createDataFrame([("k", None), ("k", 5), ("k", 6)], "k string, s long").withColumn(
        "ts", F.timestamp_seconds("s"))
    out = anchored_windows(df, ["k"], "ts", 10).collect()
    assert sorted((r.s is None, r.ordinal) for r in out) == [(False, 1), (False, 2), (True, 1)]


@pytest.mark.parametrize("boundary", ["after", "at_or_after"])
def test_range_mode_equals_hash_mode_with_hot_key(spark, boundary):
    rnd = random.Random(11)
    rows = []
    for i in range(6000):
        k = "hot" if i % 5 else f"k{i % 17}"
        rows.append((k, rnd.randrange(0, 3 * 10**8) if i % 7 else (i // 7) * 1000, i, rnd.choice([2.0, 3.5])))
    rows.append(("hot", None, 99999, 2.0))
    df = spark.createDataFrame(rows, "k string, us long, tie long, w double").withColumn("ts", F.timestamp_micros("us"))
    pas = F.col("k") == "k3"
    h = anchored_windows(df, ["k"], "ts", "w", boundary, order=["tie"], passthrough=pas).collect()
    r = anchored_windows(df, ["k"], "ts", "w", boundary, order=["tie"], passthrough=pas, mode="range",
                         num_partitions=11).collect()
    assert {x.tie: (x.window_start, x.ordinal) for x in h} == {x.tie: (x.window_start, x.ordinal) for x in r}


def test_range_mode_overflow_fallback(spark):
    from driftlog.operators.rangefold import anchored_windows_range
    rows = [("a", i * 700, i) for i in range(3000)]  # a lattice: chains never merge
    df = spark.createDataFrame(rows, "k string, us long, tie long").withColumn("ts", F.timestamp_micros("us"))
    h = anchored_windows(df, ["k"], "ts", 0.005, "after", order=["tie"]).collect()
    # max_runs=1: every one-key partition's summary overflows and is refolded alone
    r = anchored_windows_range(df, ["k"], "ts", 0.005, "after", order=["tie"], num_partitions=7,
                               max_runs=1).collect()
    assert {x.tie: (x.window_start, x.ordinal) for x in h} == {x.tie: (x.window_start, x.ordinal) for x in r}


def test_fold_slices_for_wide_windows():
    import driftlog.operators.anchored as an
    rnd = random.Random(3)
    rows = sorted((k, rnd.randrange(0, 10**6), i) for i, k in enumerate(rnd.choice("ab") for _ in range(500)))
    t = np.array([r[1] for r in rows], dtype=np.int64)
    w = np.full(t.size, 50_000, dtype=np.int64)
    ks = np.array([i == 0 or rows[i][0] != rows[i - 1][0] for i in range(len(rows))])
    want = fold_anchored(t, w, ks, True, None)
    old = an._Z_LIMIT
    an._Z_LIMIT = 50_002 * 7  # force slices of 7 rows
    try:
        got = fold_anchored(t, w, ks, True, None)
    finally:
        an._Z_LIMIT = old
    assert np.array_equal(want[0], got[0]) and np.array_equal(want[1], got[1]) and want[2] == got[2]


def test_range_mode_with_wider_window_carried_in(spark):
    # a wide window opened early must cover rows in later partitions whose own widths are small
    rows = [("k", 0, 0, 100.0)] + [("k", i * 1_000_000, i, 1.0) for i in range(1, 60)]
    df = spark.createDataFrame(rows, "k string, us long, tie long, w double").withColumn("ts", F.timestamp_micros("us"))
    h = anchored_windows(df, ["k"], "ts", "w", "after", order=["tie"], mode="hash").collect()
    r = anchored_windows(df, ["k"], "ts", "w", "after", order=["tie"], mode="range", num_partitions=6).collect()
    assert {x.tie: x.ordinal for x in h} == {x.tie: x.ordinal for x in r}
    assert max(x.ordinal for x in h) == 60  # one window of 100 s covers everything


def test_range_mode_with_chunked_summaries(spark):
    import driftlog.operators.rangefold as rf
    rows = [("hot" if i % 4 else "k", i * 1000, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, us long, tie long").withColumn("ts", F.timestamp_micros("us"))
    old = (rf.SUMMARY_COLLECT_LIMIT, rf.SUMMARY_CHUNK)
    rf.SUMMARY_COLLECT_LIMIT, rf.SUMMARY_CHUNK = 2, 3  # driver-side: read summaries back in chunks
    try:
        r = anchored_windows(df, ["k"], "ts", 0.05, "after", order=["tie"], mode="range", num_partitions=10).collect()
    finally:
        rf.SUMMARY_COLLECT_LIMIT, rf.SUMMARY_CHUNK = old
    h = anchored_windows(df, ["k"], "ts", 0.05, "after", order=["tie"], mode="hash").collect()
    assert {x.tie: (x.window_start, x.ordinal) for x in h} == {x.tie: (x.window_start, x.ordinal) for x in r}


def test_hot_key_is_split_across_tasks_in_range_mode(spark):
    # one key holds a third of all rows: range mode must spread it, hash mode keeps it in one task
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", i * 10_000, i) for i in range(9000)]
    df = spark.createDataFrame(rows, "k string, us long, tie long").withColumn("ts", F.timestamp_micros("us"))
    rng = anchored_windows(df, ["k"], "ts", 1.0, "after", order=["tie"], mode="range", num_partitions=8)
    hsh = anchored_windows(df, ["k"], "ts", 1.0, "after", order=["tie"], mode="hash", num_partitions=8)
    tasks = lambda d: d.filter("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks(hsh) == 1 and tasks(rng) >= 3
    key = lambda r: (r.tie, r.window_start, r.ordinal)
    assert sorted(map(key, rng.collect())) == sorted(map(key, hsh.collect()))


def test_copies_of_one_id_are_split_in_range_dedup(spark):
    from driftlog.operators.dedup import dedup_ttl
    from driftlog.schemas import LOG_ENTRY
    from tests.helpers import at, entry
    rows = [entry("same", ingest=at(i * 7)) for i in range(3000)] + [entry(f"u{i}", ingest=at(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, LOG_ENTRY)
    a = dedup_ttl(df, 300, mode="range", prefilter=False, num_partitions=8)
    b = dedup_ttl(df, 300, mode="hash", prefilter=False)
    anchors, last = 0, None
    for t in range(0, 3000 * 7, 7):  # brute force: a copy opens a window at first sight + TTL or later
        if last is None or t >= last + 300:
            anchors, last = anchors + 1, t
    assert a.count() == b.count() == 6000 + anchors
    assert a.filter("log_id = 'same'").select(F.spark_partition_id()).distinct().count() >= 2


def test_range_mode_many_keys_tiny_batches(spark):
    rnd = random.Random(33)
    rows = []
    for k in range(40):
        size = rnd.choice([1, 2, 5, 80, 300])
        rows += [(f"k{k:02d}", rnd.randrange(0, 2 * 10**7), len(rows) + i, rnd.choice([0.5, 2.0])) for i in range(size)]
    df = spark.createDataFrame(rows, "k string, us long, tie long, w double").withColumn("ts", F.timestamp_micros("us"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        r = anchored_windows(df, ["k"], "ts", "w", "at_or_after", order=["tie"], mode="range", num_partitions=13) \
            .select("k", "tie", F.unix_micros("window_start").alias("a"), "ordinal").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute([(k, us, int(w * 1_000_000), tie) for k, us, tie, w in rows], after=False)
    got = {(x.k, x.tie): (x.a, x.ordinal) for x in r}
    assert got == want
