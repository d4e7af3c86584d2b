"""Stream equals batch: the streaming operators replayed over files give the batch answers."""

import uuid

import pytest
from pyspark.sql import functions as F

from driftlog import fixtures as fx
from driftlog.operators.alerts import evaluate_rules
from driftlog.operators.dedup import dedup_ttl
from driftlog.plans.catalog import normalised_entries
from driftlog.plans.pipeline import process
from driftlog.sources.hot import read_hot
from driftlog.streaming.pipeline import file_source, stream_pipeline
from driftlog.streaming.stateful import alerts_stream, dedup_stream
from tests.conftest import SF001
from driftlog.schemas import LOG_ENTRY
from tests.helpers import at, entry


def _by_day_files(df, path, col="ingest_timestamp"):
    """One folder of parquet files per arrival day, written in day order (a replayable log)."""
    days = sorted(r.d for r in df.select(F.to_date(col).alias("d")).distinct().collect() if r.d is not None)
    for i, d in enumerate(days):
        df.filter(F.to_date(col) == d).coalesce(1).write.parquet(f"{path}/part={i:04d}")
    return len(days)


def _run(stream, name, ckpt):
    q = (stream.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    return q


@pytest.fixture(scope="module")
def entry_files(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("entries")
    good = normalised_entries(spark, SF001).drop("event_id")
    _by_day_files(good, str(base / "log"))
    return str(base)


def _entries_stream(spark, entry_files):
    schema = normalised_entries(spark, SF001).drop("event_id").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).parquet(f"{entry_files}/log/*")


def test_dedup_stream_equals_batch(spark, entry_files):
    name = "dd_" + uuid.uuid4().hex[:8]
    _run(dedup_stream(_entries_stream(spark, entry_files), 300, order=["log_id", "shift"]), name,
         f"{entry_files}/ck_{name}")
    got = sorted((r.log_id, r.shift, r.ingest_timestamp) for r in spark.table(name).collect())
    batch = dedup_ttl(normalised_entries(spark, SF001), 300, order=["log_id", "shift"])
    want = sorted((r.log_id, r.shift, r.ingest_timestamp) for r in batch.collect())
    assert len(got) == 1022 and got == want


def test_alerts_stream_equals_batch(spark, entry_files, tmp_path):
    # alerts run on the deduplicated stream, as downstream consumers of the normalized topic do
    dd = dedup_ttl(normalised_entries(spark, SF001), 300, order=["log_id", "shift"]).drop("event_id")
    _by_day_files(dd, str(tmp_path / "dd"))
    s = spark.readStream.schema(dd.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "dd" / "*"))
    name = "al_" + uuid.uuid4().hex[:8]
    _run(alerts_stream(s, fx.rules(spark), order=["log_id", "shift"]), name, str(tmp_path / "ck"))
    cols = ["rule", "tenant_id", "log_id", "count", "window_start"]
    got = sorted(tuple(r) for r in spark.table(name).select(*cols).collect())
    want = sorted(tuple(r) for r in evaluate_rules(dd, fx.rules(spark), order=["log_id", "shift"]).select(*cols).collect())
    assert len(want) == 1051 and got == want


def test_stream_pipeline_equals_batch(spark, tmp_path):
    raw = fx.raw_batches(spark, SF001)
    bus = raw.select(F.lit("logs-raw").alias("topic"), F.lit(None).cast("binary").alias("key"),
                     F.encode("value", "UTF-8").alias("value"), F.current_timestamp().alias("timestamp"))
    for i, chunk in enumerate(bus.randomSplit([1.0] * 4, seed=3)):
        chunk.coalesce(1).write.parquet(str(tmp_path / "raw" / f"f{i}"))
    out = str(tmp_path / "out")
    q = stream_pipeline(file_source(spark, str(tmp_path / "raw" / "*")), out, str(tmp_path / "ck"),
                        available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None
    batch = process(raw)
    assert spark.read.parquet(f"{out}/normalized").count() == batch.entries.count()
    assert spark.read.parquet(f"{out}/dead_letter").count() == batch.dead.count() == 20
    hot = read_hot(spark, f"{out}/hot")
    assert hot.count() == batch.entries.count()
    from driftlog.sources.archive import read_archive
    assert read_archive(spark, f"{out}/cold").count() == batch.entries.count()


def test_batch_pipeline_run_is_idempotent(spark, tmp_path):
    from datetime import datetime, timezone

    from driftlog.plans.pipeline import run
    raw = fx.raw_batches(spark, SF001)
    out = str(tmp_path / "out")
    wt = datetime(2024, 2, 1, 10, tzinfo=timezone.utc)
    first = run(raw, out, wt, batch_id=0)
    again = run(raw, out, wt, batch_id=0)
    assert first == again and first["dead_letter"] == 20
    n = process(raw).entries.count()
    assert first["normalized"] == n
    assert read_hot(spark, f"{out}/hot").count() == n
    from driftlog.sources.archive import read_archive
    assert read_archive(spark, f"{out}/cold").count() == n


def test_stream_pipeline_dedups_across_micro_batches(spark, tmp_path):
    import json

    def batch(*entries):
        return json.dumps({"entries": [dict(tenant_id="t1", message="m", **e) for e in entries]})

    files = [
        [batch({"log_id": "a", "ingest_timestamp": "2024-01-01T00:00:00Z"},
               {"log_id": "", "ingest_timestamp": "2024-01-01T00:00:00Z"})],
        [batch({"log_id": "a", "ingest_timestamp": "2024-01-01T00:04:59Z"},  # within the TTL: dropped
               {"log_id": "", "ingest_timestamp": "2024-01-01T00:04:59Z"}), "not json"],
        [batch({"log_id": "a", "ingest_timestamp": "2024-01-01T00:05:00Z"})],  # first sight + TTL: new
    ]
    for i, values in enumerate(files):
        rows = [("logs-raw", None, v.encode(), None) for v in values]
        spark.createDataFrame(rows, "topic string, key binary, value binary, timestamp timestamp") \
            .coalesce(1).write.parquet(str(tmp_path / "raw" / f"f{i}"))
    out = str(tmp_path / "out")
    q = stream_pipeline(file_source(spark, str(tmp_path / "raw" / "*")), out, str(tmp_path / "ck"), available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None
    bus = spark.read.parquet(f"{out}/normalized").select(
        F.get_json_object("value", "$.log_id").alias("id"), F.col("timestamp").cast("string").alias("t")).collect()
    assert sorted((r.id, r.t) for r in bus) == [
        ("", "2024-01-01 00:00:00"), ("", "2024-01-01 00:04:59"), ("a", "2024-01-01 00:00:00"),
        ("a", "2024-01-01 00:05:00")]
    # the hot table keeps the last write per (tenant, day, id)
    hot = {(r.log_id, str(r.ingest_timestamp)) for r in read_hot(spark, f"{out}/hot").collect()}
    assert ("a", "2024-01-01 00:05:00") in hot and ("a", "2024-01-01 00:00:00") not in hot
    assert spark.read.parquet(f"{out}/dead_letter").count() == 1


# ---- transformWithState


def _split(spark, df, col, n, path, seed):
    """The rows in order of ``col``, cut at random into ``n`` micro-batches."""
    import random

    rows = df.orderBy(col).collect()
    cuts = [0, *sorted(random.Random(seed).sample(range(1, len(rows)), n - 1)), len(rows)]
    for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        spark.createDataFrame(rows[lo:hi], df.schema).coalesce(1).write.parquet(f"{path}/p={k:03d}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def test_throttle_stream_equals_batch(spark, tmp_path):
    from driftlog.operators.throttle import throttle
    from driftlog.streaming.keyed import throttle_stream

    untimed = spark.createDataFrame([("none", "tenant-1", "k1", None, -1)], fx.requests(spark, SF001).schema)
    requests = fx.requests(spark, SF001).unionByName(untimed)
    columns = ["request_id", "admitted", "tokens_left"]
    name = "tb_" + uuid.uuid4().hex[:8]
    _run(throttle_stream(_split(spark, requests, "ts", 3, str(tmp_path / "rq"), 5), 10, order=["request_id"]), name, str(tmp_path / "ck"))
    want = throttle(requests, 10, order=["request_id"])
    assert sorted(map(str, spark.table(name).select(columns).collect())) == sorted(map(str, want.select(columns).collect()))


def test_running_counter_stream_equals_batch(spark, tmp_path):
    from driftlog.operators.sessions import running_counter
    from driftlog.streaming.keyed import running_counter_stream

    entries = dedup_ttl(normalised_entries(spark, SF001), 300, order=["log_id", "shift"])
    keys, order = ["tenant_id", "service"], ["log_id", "shift"]
    columns = ["log_id", "shift", "event_id", "counter", "session_start"]
    name = "rc_" + uuid.uuid4().hex[:8]
    stream = running_counter_stream(_split(spark, entries, "ingest_timestamp", 3, str(tmp_path / "e"), 6), keys, "ingest_timestamp", 600, order=order)
    _run(stream, name, str(tmp_path / "ck"))
    want = running_counter(entries, keys, "ingest_timestamp", 600, order=order)
    assert sorted(map(str, spark.table(name).select(columns).collect())) == sorted(map(str, want.select(columns).collect()))


def test_state_goes_after_the_retention_time(spark, tmp_path):
    """A bucket by time to live, a counter by its timer: a key that was silent starts anew."""
    import time

    from driftlog.streaming.keyed import running_counter_stream, throttle_stream

    schema = "k string, ts timestamp, n int"
    path = str(tmp_path / "in")
    batch = lambda k: spark.createDataFrame([("a", at(0), 3 * k + j) for j in range(3)], schema).coalesce(1).write.parquet(f"{path}/p={k}")
    source = spark.readStream.schema(schema).parquet(f"{path}/*")
    batch(0)
    streams = {"rt": throttle_stream(source, 2, "k", "ts", ["n"], retention_seconds=2), "rk": running_counter_stream(source, ["k"], "ts", 60, ["n"], retention_seconds=2)}
    queries = [s.writeStream.format("memory").queryName(n).option("checkpointLocation", str(tmp_path / n)).trigger(processingTime="1 second").start() for n, s in streams.items()]

    def wait(rows):
        for _ in range(120):
            if all(spark.table(n).count() >= rows for n in streams):
                return
            time.sleep(1)
        raise AssertionError([q.exception() for q in queries])

    wait(3)
    time.sleep(8)  # longer than the retention
    batch(1)
    wait(6)
    for q in queries:
        q.stop()
    assert [r.admitted for r in spark.table("rt").orderBy("n").collect()] == [True, True, False] * 2
    assert [r.counter for r in spark.table("rk").orderBy("n").collect()] == [1, 2, 3] * 2


def test_a_key_with_one_row_is_folded_without_a_copy(monkeypatch):
    import pandas as pd

    from driftlog.streaming import stateful

    class State:
        exists = hasTimedOut = False
        getCurrentProcessingTimeMs = getCurrentWatermarkMs = lambda self: 0
        setTimeoutTimestamp = lambda self, ms: None

        def update(self, new):
            self.new = new

    monkeypatch.setattr(stateful.pd, "concat", lambda *a, **k: pytest.fail("copied"))
    state, row = State(), pd.DataFrame({stateful._T: [7], stateful._W: [3], "log_id": ["a"]})
    fold = stateful._handler(["log_id"], False, lambda pdf, anchor, ordinal: pdf[ordinal == 1])
    assert [len(x) for x in fold(("a",), iter([row]), state)] == [1] and tuple(state.new) == (7, 10, 1)


def test_rows_come_out_of_the_stream_as_they_went_in(spark, tmp_path):
    texts = ["", "\n\t\"\\ é \U0001f600", '{"a": [1]}', None, " x "]
    rows = [entry(f"k{k}", message=m, service=m, level=None, event=at(k + 0.000001), ingest=at(k), fields={"f": "\"1\""}) for k, m in enumerate(texts)]
    rows.append(entry("", message="no id", event=None, ingest=None))
    spark.createDataFrame(rows, LOG_ENTRY).write.parquet(str(tmp_path / "in"))
    stream = dedup_stream(spark.readStream.schema(LOG_ENTRY).parquet(str(tmp_path / "in")), 300)
    _run(stream, "as_they_went_in", str(tmp_path / "ck"))
    got = spark.table("as_they_went_in")
    assert got.columns == LOG_ENTRY.names
    assert sorted(map(repr, got.collect())) == sorted(map(repr, spark.createDataFrame(rows, LOG_ENTRY).collect()))


def test_dedup_state_has_a_row_for_a_bucket_not_for_a_key(spark, tmp_path, monkeypatch):
    from driftlog.streaming import stateful

    monkeypatch.setattr(stateful, "BUCKETS", 4, raising=False)
    for k in range(2):  # the second file: each key once within the time limit and once at its end
        rows = [entry(f"k{i}", ingest=at(t)) for i in range(50) for t in ((0, 1) if k == 0 else (299, 300))]
        spark.createDataFrame(rows, LOG_ENTRY).coalesce(1).write.parquet(str(tmp_path / "in" / f"f{k}"))
    stream = spark.readStream.schema(LOG_ENTRY).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    q = _run(dedup_stream(stream, 300), "few_state_rows", str(tmp_path / "ck"))
    got = sorted((r.log_id, r.ingest_timestamp) for r in spark.table("few_state_rows").collect())
    assert [x[0] for x in got] == sorted(f"k{i}" for i in range(50) for _ in range(2))
    assert {(b - a).total_seconds() for (_, a), (_, b) in zip(got[::2], got[1::2], strict=True)} == {300}
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 4


def test_a_bucket_drops_each_key_in_its_time(monkeypatch):
    import pandas as pd

    from driftlog.streaming import stateful

    class State:
        exists = hasTimedOut = False
        now = 0
        getCurrentProcessingTimeMs = getCurrentWatermarkMs = lambda self: self.now
        get = property(lambda self: self.value)

        def setTimeoutTimestamp(self, ms):
            self.timeout = ms

        def update(self, new):
            self.value, self.exists = new, True

        def remove(self):
            self.exists = False

    state, fold = State(), stateful._bucket_handler([], ["id"], retention_seconds=5)

    def call(*rows):
        pdf = pd.DataFrame(rows, columns=["id", stateful._K, stateful._T, stateful._P])
        pdf[stateful._W] = 1_000
        return sorted(x for p in fold((0,), iter([pdf]), state) for x in p["id"])

    def held():
        return sorted(stateful._read_windows(state.get[0])["key"].to_pylist()) if state.exists else []

    assert call((1, "a", 0, False), (2, "b", 0, False), (3, "a", 999, False), (4, None, 0, True), (5, "a", 1_000, False)) == [1, 2, 4, 5]
    assert held() == ["a", "b"] and state.timeout == 1 + 5_000
    state.now = 3_000
    assert call((6, "b", 500, False), (7, "c", -5, False), (8, "c", -9, False)) == [8] and held() == ["a", "b", "c"]
    state.now = 5_002  # a's time is over, it was not seen since
    assert call((9, "a", 1_001, False)) == [] and held() == ["a", "b", "c"]  # rows of a micro-batch come before its timeouts
    state.now, state.hasTimedOut = 9_000, True
    assert call() == [] and held() == ["a"]
    state.now = 20_000
    assert call() == [] and not state.exists


def test_stream_writes_one_file_for_a_tenant_and_day(spark, tmp_path):
    import json

    entries = [{"log_id": f"k{i}", "tenant_id": "t1", "message": "m", "ingest_timestamp": "2024-01-01T00:00:00Z"} for i in range(200)]
    spark.createDataFrame([("logs-raw", None, json.dumps({"entries": entries}).encode(), None)],
                          "topic string, key binary, value binary, timestamp timestamp").write.parquet(str(tmp_path / "raw"))
    q = stream_pipeline(file_source(spark, str(tmp_path / "raw")), str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None and read_hot(spark, str(tmp_path / "out" / "hot")).count() == 200
    assert len(list((tmp_path / "out" / "hot").rglob("*.parquet"))) == len(list((tmp_path / "out" / "cold").rglob("*.gz"))) == 1
