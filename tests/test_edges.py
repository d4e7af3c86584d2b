"""Rows that are late, lack a key or a time, or are cut: none is lost or changed."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from driftlog import fixtures as fx
from driftlog.operators.decode import cap_body
from driftlog.operators.dedup import dedup_ttl
from driftlog.operators.sessions import running_counter, session_counter
from driftlog.operators.throttle import throttle
from driftlog.plans.pipeline import process
from driftlog.session import ensure_checkpoint_dir
from driftlog.sources.archive import archive, read_archive
from driftlog.sources.bus import file_source
from driftlog.streaming.pipeline import stream_pipeline
from tests.conftest import SF001
from tests.helpers import at, entries_df, entry

BUS = "topic string, key binary, value binary, timestamp timestamp"


def run_stream(spark, tmp_path, **options):
    out = str(tmp_path / "out")
    src = file_source(spark, str(tmp_path / "raw" / "*"), **options)
    q = stream_pipeline(src, out, str(tmp_path / "ck"), available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None
    return spark.read.parquet(f"{out}/normalized"), spark.read.parquet(f"{out}/dead_letter")


def test_late_entries_are_kept_by_the_stream(spark, tmp_path):
    times = ["2024-01-01T12:00:00Z", "2024-01-01T12:30:00Z", "2024-01-01T09:00:00Z", "2024-01-01T13:00:00Z"]
    for i, t in enumerate(times):
        value = json.dumps({"entries": [{"tenant_id": "t1", "message": "m", "log_id": f"id{i}", "ingest_timestamp": t}]})
        spark.createDataFrame([("logs-raw", None, value.encode(), None)], BUS).coalesce(1).write.parquet(str(tmp_path / "raw" / f"f{i}"))
    normalized, dead = run_stream(spark, tmp_path)
    ids = {r[0] for r in normalized.select(F.get_json_object("value", "$.log_id")).collect()}
    assert ids == {"id0", "id1", "id2", "id3"} and dead.count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_batch_for_any_split_into_files(spark, tmp_path, seed):
    raw = fx.raw_batches(spark, SF001)
    bus = raw.select(F.lit("logs-raw").alias("topic"), F.lit(None).cast("binary").alias("key"),
                     F.encode("value", "UTF-8").alias("value"), F.current_timestamp().alias("timestamp"))
    for i, chunk in enumerate(bus.randomSplit([1.0] * 4, seed=seed)):
        chunk.coalesce(1).write.parquet(str(tmp_path / "raw" / f"f{i}"))
    normalized, dead = run_stream(spark, tmp_path)
    batch = process(raw)
    assert normalized.count() == batch.entries.count() and dead.count() == batch.dead.count()


@pytest.mark.parametrize("mode", ["hash", "range"])
@pytest.mark.parametrize("prefilter", [False, True])
def test_null_keys_dedup_alike_in_every_plan(spark, mode, prefilter):
    rows = [entry("a", tenant_id=None, ingest=at(0)), entry("a", tenant_id=None, ingest=at(1)), entry("a", tenant_id="t", ingest=at(2))]
    out = dedup_ttl(entries_df(spark, rows), keys=["tenant_id", "log_id"], mode=mode, prefilter=prefilter)
    assert out.count() == 2


def test_events_without_a_key_are_counted(spark):
    ev = spark.createDataFrame([(None, at(0)), (None, at(1)), ("k", at(0))], "k string, ts timestamp")
    assert sorted(r["counter"] for r in running_counter(ev, ["k"], "ts", 60).collect()) == [1, 1, 2]
    assert sorted(r["count"] for r in session_counter(ev, ["k"], "ts", 60).collect()) == [1, 2]


@pytest.mark.parametrize("mode", ["hash", "range"])
def test_requests_without_a_time_pass_the_throttle(spark, mode):
    rows = [("t", None), ("t", at(0)), ("t", at(0)), ("u", at(0))]
    out = throttle(spark.createDataFrame(rows, "tenant_id string, ts timestamp"), 1.0, mode=mode).collect()
    assert sorted((r["ts"] is None, r["admitted"]) for r in out) == [(False, False), (False, True), (False, True), (True, True)]


def test_missing_times_come_back_missing(spark, tmp_path):
    df = entries_df(spark, [entry("a", event=None, ingest=None), entry("b", event=at(0), ingest=at(1))])
    archive(df, str(tmp_path / "cold"), datetime(2024, 1, 1, tzinfo=timezone.utc))
    got = {r["log_id"]: r for r in read_archive(spark, str(tmp_path / "cold")).collect()}
    assert got["a"]["event_timestamp"] is None and got["a"]["ingest_timestamp"] is None
    assert got["b"]["ingest_timestamp"] - got["b"]["event_timestamp"] == timedelta(seconds=1)


def test_a_body_cut_inside_a_character_does_not_fail(spark):
    df = spark.createDataFrame([("abcdé",), ("ab",)], "v string")
    assert [r[0] for r in df.select(cap_body(F.col("v"), 5)).collect()] == ["abcd�", "ab"]


def test_the_checkpoint_folder_does_not_nest(spark):
    first = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    for _ in range(5):
        ensure_checkpoint_dir(spark)
    assert spark.sparkContext._jsc.sc().getCheckpointDir().get() == first
