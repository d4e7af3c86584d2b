"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (through the fixtures in
``driftlog.fixtures``) and runs over them whole. Times leave as integer
microseconds (``*_us``) so results compare exactly with the SQL oracles.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog import fixtures as fx
from driftlog.functions.levels import extract_level
from driftlog.operators.alerts import evaluate_rules, match_rules
from driftlog.operators.bucketmaps import throttle_exact
from driftlog.operators.decode import dead_letter, decode_batches
from driftlog.operators.dedup import dedup_ttl
from driftlog.operators.gateway import gateway
from driftlog.operators.ingest import assemble_batches, authorize, parse_lines, stamp_ingest
from driftlog.operators.normalise import normalise
from driftlog.operators.numbering import number_within
from driftlog.operators.paging import page_at
from driftlog.operators.routing import route_keys
from driftlog.operators.search import SearchRequest, order_columns, route_tier, search, search_many, search_tiers
from driftlog.operators.seen import SeenIds
from driftlog.operators.sessions import running_counter, session_counter
from driftlog.operators.tail import tail_fanout
from driftlog.operators.throttle import throttle
from driftlog.plans.pipeline import process
from driftlog.session import apply_conf, ensure_checkpoint_dir
from driftlog.schemas import BUS_MESSAGE
from driftlog.sources.archive import archive, index_archive, read_archive
from driftlog.sources.bus import file_source, normalized_rows
from driftlog.sources.files import Folder, read_batch_files, read_lines, read_spool
from driftlog.sources.hot import HotTable, last_write_wins, read_hot, upsert_hot
from driftlog.streaming.pipeline import stream_pipeline

# Parameters of the registered queries.
DEDUP_TTL_S = 300
SESSION_GAP_S = 600
THROTTLE_RPS = 10
BATCH_SIZE = 4
TAIL_CAP = 64
ARCHIVE_WRITE_TIME = datetime(2024, 2, 1, 10, 0, tzinfo=timezone.utc)
ARCHIVE_PART = 7
STAMP_TIME = datetime(2024, 3, 1, tzinfo=timezone.utc)
STREAM_FILES = 16  # files of one micro-batch
SEARCH_NOW = datetime(2024, 1, 30, tzinfo=timezone.utc)
COLD_HOURS = (datetime(2024, 1, 15, 22, 30, tzinfo=timezone.utc), datetime(2024, 1, 16, 1, 30, tzinfo=timezone.utc))
FLAGSHIP_REQUEST = {"level": "ERROR", "service": "error", "from": "2024-01-01T00:00:00Z",
                    "to": "2024-01-31T00:00:00Z", "page": "1", "page_size": "100"}


def us(c: str):
    return F.unix_micros(F.col(c))


def _spark(spark: SparkSession) -> SparkSession:
    ensure_checkpoint_dir(spark)
    return apply_conf(spark)


def normalised_entries(spark: SparkSession, d: str) -> DataFrame:
    good, _ = normalise(fx.log_entries(spark, d))
    return good


def deduped_entries(spark: SparkSession, d: str) -> DataFrame:
    return dedup_ttl(normalised_entries(spark, d), DEDUP_TTL_S, order=["log_id", "shift"])


def q_normalise(spark, d):
    spark = _spark(spark)
    g = normalised_entries(spark, d)
    return g.select("log_id", "tenant_id", "service", "level", "message", us("event_timestamp").alias("event_us"),
                    us("ingest_timestamp").alias("ingest_us"), F.col("shift").cast("long").alias("shift"), "event_id")


def q_dedup_ttl(spark, d):
    spark = _spark(spark)
    return deduped_entries(spark, d).select(
        "log_id", "tenant_id", F.col("shift").cast("long").alias("shift"), "event_id",
        us("ingest_timestamp").alias("ingest_us"))


def q_evaluate_rules(spark, d):
    spark = _spark(spark)
    a = evaluate_rules(deduped_entries(spark, d), fx.rules(spark), order=["log_id", "shift"])
    return a.select("rule", "tenant_id", "service", F.col("count").cast("long").alias("count"),
                    us("fired_at").alias("fired_us"), "sample_message", "webhook", "log_id",
                    us("window_start").alias("window_start_us"))


def q_alerts_first(spark, d):
    spark = _spark(spark)
    a = evaluate_rules(deduped_entries(spark, d), fx.rules(spark), order=["log_id", "shift"], first_only=True)
    return a.select("rule", "tenant_id", "log_id", F.col("count").cast("long").alias("count"),
                    us("fired_at").alias("fired_us"), us("window_start").alias("window_start_us"))


def q_alerts_aligned(spark, d):
    spark = _spark(spark)
    a = evaluate_rules(deduped_entries(spark, d), fx.rules(spark), order=["log_id", "shift"], aligned=True)
    return a.select("rule", "tenant_id", "log_id", F.col("count").cast("long").alias("count"),
                    us("fired_at").alias("fired_us"), us("window_start").alias("window_start_us"))


def q_rule_windows(spark, d):
    spark = _spark(spark)
    s = evaluate_rules(deduped_entries(spark, d), fx.rules(spark), order=["log_id", "shift"], with_state=True)
    return s.groupBy("rule", "tenant_id", us("window_start").alias("window_start_us")).agg(
        F.count(F.lit(1)).cast("long").alias("matches"), F.max("count").cast("long").alias("max_count"))


def _flagship_request() -> SearchRequest:
    return SearchRequest.parse("tenant-0", FLAGSHIP_REQUEST, SEARCH_NOW)


def q_search_one(spark, d):
    spark = _spark(spark)
    table = deduped_entries(spark, d).withColumn("event_date", F.to_date("event_timestamp"))
    page, _ = search(table, _flagship_request())
    return page.select("log_id", "tenant_id", "service", "level", "message",
                       us("event_timestamp").alias("event_us"), us("ingest_timestamp").alias("ingest_us"))


def q_search_hot(spark, d):
    """The flagship request against the real hot table: day partitions pruned, filters pushed."""
    spark = _spark(spark)
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/hot-{uuid.uuid4().hex}"
    upsert_hot(deduped_entries(spark, d), path)
    page, _ = search(read_hot(spark, path), _flagship_request())
    return page.select("log_id", "tenant_id", "service", "level", "message",
                       us("event_timestamp").alias("event_us"), us("ingest_timestamp").alias("ingest_us"))


def q_search_cold(spark, d):
    """The flagship request against the cold tier: archive written, read back (tenant pruned), searched."""
    spark = _spark(spark)
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/cold-{uuid.uuid4().hex}"
    archive(deduped_entries(spark, d), path, ARCHIVE_WRITE_TIME)
    page, _ = search(read_archive(spark, path, tenant="tenant-0"), _flagship_request())
    return page.select("log_id", "tenant_id", "service", "level", "message",
                       us("event_timestamp").alias("event_us"), us("ingest_timestamp").alias("ingest_us"))


def _routed(spark, d):
    return route_tier(fx.daily_requests(spark, d), SEARCH_NOW)


def q_route_tier(spark, d):
    spark = _spark(spark)
    return _routed(spark, d).select("request_id", us("from_ts").alias("from_us"), us("to_ts").alias("to_us"),
                                 "page_no", "size", "tier")


def q_search_pages(spark, d):
    spark = _spark(spark)
    page, _ = search_many(deduped_entries(spark, d), _routed(spark, d))
    return page.select(F.col("search_id").alias("request_id"), "rank", "log_id", us("event_timestamp").alias("event_us"),
                       us("ingest_timestamp").alias("ingest_us"))


def q_search_totals(spark, d):
    spark = _spark(spark)
    _, totals = search_many(deduped_entries(spark, d), _routed(spark, d))
    return totals.select(F.col("search_id").alias("request_id"), "page_no", "size", "tier", "total")


def q_upsert_hot(spark, d):
    spark = _spark(spark)
    rows = last_write_wins(normalised_entries(spark, d).withColumn("event_date", F.to_date("event_timestamp")),
                           order=["log_id", "shift"])
    return rows.select("tenant_id", F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), "log_id",
                       us("ingest_timestamp").alias("ingest_us"), F.col("shift").cast("long").alias("shift"),
                       "event_id")


def q_route_keys(spark, d):
    spark = _spark(spark)
    r = route_keys(deduped_entries(spark, d), ARCHIVE_WRITE_TIME, ARCHIVE_PART)
    return r.select("log_id", F.col("shift").cast("long").alias("shift"), "event_id", "partition_key",
                    "index_name", "archive_path")


def _lines_entries(spark, d):
    return parse_lines(fx.raw_lines(spark, d), tenant_id="tenant-0", service="docs", host="h1",
                       environment="test")


def q_parse_lines(spark, d):
    spark = _spark(spark)
    e = _lines_entries(spark, d)
    return e.select("doc_id", F.col("pos").cast("long").alias("pos"), "log_id", "level", "message",
                    us("event_timestamp").alias("event_us"))


def _batches(spark, d):
    return assemble_batches(_lines_entries(spark, d), BATCH_SIZE, sent_at=F.lit(STAMP_TIME))


def q_assemble_batches(spark, d):
    spark = _spark(spark)
    b = _batches(spark, d)
    return b.select("agent_id", "batch_no", F.size("entries").cast("long").alias("n_entries"),
                    F.element_at("entries", 1)["log_id"].alias("first_log_id"),
                    F.element_at("entries", -1)["log_id"].alias("last_log_id"))


def q_stamp_ingest(spark, d):
    spark = _spark(spark)
    b = _batches(spark, d).withColumn(
        "tenant_id", F.concat(F.lit("tenant-"), (F.substring("agent_id", 2, 20).cast("long") % 4).cast("string")))
    s = stamp_ingest(b, "tenant_id", F.lit(STAMP_TIME))
    x = s.select("agent_id", "batch_no", "key", F.posexplode("entries").alias("position", "e"))
    return x.select("agent_id", "batch_no", "key", F.col("position").cast("long").alias("position"),
                    F.col("e.log_id").alias("log_id"), F.col("e.tenant_id").alias("tenant_id"),
                    us("e.ingest_timestamp").alias("ingest_us"))


def q_decode_batches(spark, d):
    spark = _spark(spark)
    e, _ = decode_batches(fx.raw_batches(spark, d))
    return e.select("batch_id", F.col("position").cast("long").alias("position"), "agent_id", "log_id",
                    "tenant_id", "service", "level", "message", us("event_timestamp").alias("event_us"),
                    us("ingest_timestamp").alias("ingest_us"))


def q_dead_letter(spark, d):
    spark = _spark(spark)
    e, bad = decode_batches(fx.raw_batches(spark, d).unionByName(fx.damaged_batches(spark, d)))
    _, rejected = normalise(e)
    dl = dead_letter(bad, rejected)
    return dl.select(F.split("reason", ":")[0].alias("reason_kind"), "payload")


def q_authorize(spark, d):
    spark = _spark(spark)
    admitted, _ = authorize(fx.requests(spark, d), fx.api_keys(spark))
    return admitted.select("request_id", "tenant_id")


def q_authorize_rejected(spark, d):
    spark = _spark(spark)
    _, rejected = authorize(fx.requests(spark, d), fx.api_keys(spark))
    return rejected.select("request_id", "tenant_id", "api_key")


def q_throttle(spark, d):
    spark = _spark(spark)
    t = throttle(fx.requests(spark, d), THROTTLE_RPS, order=["request_id"])
    return t.select("request_id", "tenant_id", F.col("admitted").cast("int").alias("admitted"))


def q_session_counter(spark, d):
    spark = _spark(spark)
    s = session_counter(deduped_entries(spark, d), ["tenant_id", "service"], "ingest_timestamp", SESSION_GAP_S)
    return s.select("tenant_id", "service", us("session_start").alias("session_start_us"),
                    us("session_end").alias("session_end_us"), F.col("count").cast("long").alias("count"))


def q_running_counter(spark, d):
    spark = _spark(spark)
    r = running_counter(deduped_entries(spark, d), ["tenant_id", "service"], "ingest_timestamp", SESSION_GAP_S,
                        order=["log_id", "shift"])
    return r.select("tenant_id", "service", "log_id", F.col("shift").cast("long").alias("shift"),
                    us("ingest_timestamp").alias("ingest_us"), F.col("counter").cast("long").alias("counter"),
                    us("session_start").alias("session_start_us"))


def q_tail_fanout(spark, d):
    spark = _spark(spark)
    e = deduped_entries(spark, d).withColumn("round", F.date_trunc("minute", "ingest_timestamp"))
    t = tail_fanout(e, fx.subscriptions(spark), cap=TAIL_CAP, round_col="round",
                    order=["ingest_timestamp", "log_id", "shift"])
    return t.select("subscriber_id", "log_id", "tenant_id", "service", "level",
                    F.col("shift").cast("long").alias("shift"))


def q_tail_frames(spark, d):
    """Delivered event-stream frames (the JSON encoding of each entry) for every subscriber."""
    spark = _spark(spark)
    e = deduped_entries(spark, d).withColumn("round", F.date_trunc("minute", "ingest_timestamp"))
    t = tail_fanout(e, fx.subscriptions(spark), cap=TAIL_CAP, round_col="round",
                    order=["ingest_timestamp", "log_id", "shift"])
    return t.select("subscriber_id", "log_id", F.col("shift").cast("long").alias("shift"), "frame")


def q_archive_roundtrip(spark, d):
    spark = _spark(spark)
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/archive-{uuid.uuid4().hex}"
    archive(deduped_entries(spark, d), path, ARCHIVE_WRITE_TIME)
    r = read_archive(spark, path)
    return r.select("log_id", "tenant_id", "service", "level", "message", us("event_timestamp").alias("event_us"),
                    us("ingest_timestamp").alias("ingest_us"), us("archived_hour").alias("archived_hour_us"))


def q_pipeline(spark, d):
    spark = _spark(spark)
    out = process(fx.raw_batches(spark, d), parsed_once=True)  # as ``run`` does: raw JSON parsed once
    n = out.normalized.select(F.lit("normalized").alias("output"), F.col("key").alias("detail"))
    dl = out.dead.select(F.lit("dead_letter").alias("output"), F.split("reason", ":")[0].alias("detail"))
    return n.unionByName(dl).groupBy("output", "detail").agg(F.count(F.lit(1)).cast("long").alias("n"))


def _scratch(spark, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def q_hot_generations(spark, d):
    """Two overlapping generations, each written twice under its batch id, merged on read."""
    spark = _spark(spark)
    table = HotTable(spark, _scratch(spark, "generations"))
    rows = normalised_entries(spark, d)
    for _ in range(2):
        table.append(rows.where("shift < 300"), batch_id=0)
        table.append(rows.where("shift >= 300 or event_id % 5 = 0"), batch_id=1)
    return table.read().select("tenant_id", F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), "log_id", "message",
                               us("event_timestamp").alias("event_us"), us("ingest_timestamp").alias("ingest_us"))


def q_match_many(spark, d):
    """A rule for every order against all entries: windows of messages meet needles by hash."""
    spark = _spark(spark)
    m = match_rules(normalised_entries(spark, d), fx.many_rules(spark, d))
    return m.select("rule", "log_id", F.col("shift").cast("long").alias("shift"), "event_id")


def q_throttle_overload(spark, d):
    """One tenant with five times the requests it may make, spread over all partitions."""
    spark = _spark(spark)
    requests = fx.requests(spark, d).withColumn("tenant_id", F.lit("tenant-all"))
    t = throttle_exact(requests, THROTTLE_RPS, order=["event_id"])
    return t.select("request_id", F.col("admitted").cast("int").alias("admitted"), F.round(F.col("tokens_left") * 1_000_000).cast("long").alias("micro_tokens"))


def q_dedup_batches(spark, d):
    """The entries in three batches by arrival, each a run of its own that remembers the ids of those before."""
    spark = _spark(spark)
    seen = SeenIds(spark, _scratch(spark, "seen"), DEDUP_TTL_S)
    rows = normalised_entries(spark, d)
    # cuts of the arrival time; repeats fall on both sides of them
    lo, hi = rows.agg(F.min(us("ingest_timestamp")), F.max(us("ingest_timestamp"))).first()
    part = F.least(F.floor((us("ingest_timestamp") - lo) * 3 / F.lit(hi - lo + 1)), F.lit(2))
    out = None
    for k in range(3):
        kept = seen.dedup(rows.where(part == k), k, order=["log_id", "shift"])
        out = kept if out is None else out.unionByName(kept)
    return out.select("log_id", "tenant_id", F.col("shift").cast("long").alias("shift"), "event_id", us("ingest_timestamp").alias("ingest_us"))


def q_gateway(spark, d):
    """Authorize, throttle, decode and stamp: a row for each entry of an accepted batch and each refused request."""
    spark = _spark(spark)
    responses, messages = gateway(fx.gateway_requests(spark, d), fx.api_keys(spark), THROTTLE_RPS)
    no = F.lit(None)
    refused = responses.where(F.col("status") != 202).select(
        "request_id", "status", no.cast("string").alias("key"), no.cast("long").alias("position"), no.cast("string").alias("log_id"),
        "tenant_id", no.cast("long").alias("ingest_us"))
    return refused.unionByName(messages.select(
        F.col("call_id").alias("request_id"), F.lit(202).alias("status"), "key", F.col("position").cast("long").alias("position"), "log_id", "tenant_id",
        us("ingest_timestamp").alias("ingest_us")))


def q_search_tiers(spark, d):
    """The daily requests, each against its tier: the hot table or the archive."""
    spark = _spark(spark)
    rows = deduped_entries(spark, d).checkpoint(eager=True)
    hot, cold = _scratch(spark, "tier-hot"), _scratch(spark, "tier-cold")
    upsert_hot(rows, hot)
    archive(rows, cold, ARCHIVE_WRITE_TIME)
    page, _ = search_tiers(read_hot(spark, hot), read_archive(spark, cold), _routed(spark, d))
    return page.select(F.col("search_id").alias("request_id"), "tier", "rank", "log_id", us("event_timestamp").alias("event_us"))


def q_search_deep(spark, d):
    """A page behind three quarters of a tenant's entries, found by selection and not by a top-k."""
    spark = _spark(spark)
    rows = deduped_entries(spark, d).where("tenant_id = 'tenant-1'").checkpoint(eager=True)
    keys = [us("event_timestamp"), us("ingest_timestamp")]
    page = page_at(rows, keys, order_columns(), rows.count() * 3 // 4, 100, most=200)
    return page.select("log_id", "service", us("event_timestamp").alias("event_us"), us("ingest_timestamp").alias("ingest_us"))


def q_cold_hours(spark, d):
    """Three hours of event time from an archive by write day; the zone map tells which objects to open."""
    spark = _spark(spark)
    path = _scratch(spark, "zones")
    archive(deduped_entries(spark, d), path, F.date_trunc("day", "ingest_timestamp"))
    index_archive(spark, path)
    rows = read_archive(spark, path, None, *COLD_HOURS).where(F.col("event_timestamp").between(*(F.lit(t) for t in COLD_HOURS)))
    return rows.select("log_id", "tenant_id", "service", us("event_timestamp").alias("event_us"), us("ingest_timestamp").alias("ingest_us"))


def q_normalized(spark, d):
    """The normalized topic: key, value, time, and each message's place among those of its key."""
    spark = _spark(spark)
    path = _scratch(spark, "normalized")
    out = process(fx.raw_batches(spark, d), parsed_once=True)
    normalized_rows(out.entries).write.parquet(path)  # Kafka-shaped rows
    bus = spark.read.schema(BUS_MESSAGE).parquet(path)
    bus = bus.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), us("timestamp").alias("time_us"))
    return number_within(bus, ["key"], ["time_us", "value"], out="position")


def q_spool_replay(spark, d):
    """Batches out of whole files: a plain spool and a compressed one, each file one message. A file's name tells
    how many entries of its part lie in the files before."""
    spark = _spark(spark)
    base = _scratch(spark, "spool")
    files = fx.spool_files(spark, d)
    plain, packed = files.where("part % 2 = 0"), files.where("part % 2 = 1")
    plain.write.partitionBy("part", "start").text(f"{base}/plain")
    packed.write.partitionBy("part", "start").option("compression", "gzip").text(f"{base}/packed")
    raw = read_spool(spark, f"{base}/plain").withColumn("form", F.lit("plain")).unionByName(
        read_batch_files(spark, f"{base}/packed").withColumn("form", F.lit("packed")))
    e, _ = decode_batches(raw)
    start = F.regexp_extract("source_file", "/start=([0-9]+)/", 1).cast("long")
    return e.select("form", (start + F.col("position")).alias("position"), "agent_id", "log_id", "tenant_id", "service", "message")


def q_file_lines(spark, d):
    """Raw lines read back from files, with the level that each names."""
    spark = _spark(spark)
    path = _scratch(spark, "lines")
    fx.raw_lines(spark, d).select("line").write.text(path)
    return read_lines(spark, path).select("line", extract_level(F.col("line")).alias("level"))


def q_stream_outputs(spark, d):
    """The streaming pipeline over bus messages, run until they are used up: what lies in its four outputs."""
    spark = _spark(spark)
    base = _scratch(spark, "stream")
    raw = fx.raw_batches(spark, d).unionByName(fx.damaged_batches(spark, d))
    raw.select(F.lit("logs-raw").alias("topic"), F.lit(None).cast("binary").alias("key"), F.encode("value", "UTF-8").alias("value"),
               F.lit(STAMP_TIME).alias("timestamp")).repartition(3 * STREAM_FILES).write.parquet(f"{base}/raw")
    query = stream_pipeline(file_source(spark, f"{base}/raw", STREAM_FILES), f"{base}/out", f"{base}/checkpoint", available_now=True)
    query.awaitTermination()
    bus = spark.read.parquet(f"{base}/out/normalized").select(F.lit("normalized").alias("output"), "key", "value")
    dead = spark.read.parquet(f"{base}/out/dead_letter").select(F.lit("dead_letter").alias("output"), F.split("reason", ":")[0].alias("key"), F.col("payload").alias("value"))
    hot = read_hot(spark, f"{base}/out/hot").select(F.lit("hot").alias("output"), F.col("tenant_id").alias("key"), F.col("log_id").alias("value"))
    cold = [read_archive(spark, f"{base}/out/cold/{b}") for b in Folder(spark, f"{base}/out/cold").names("")]
    cold = reduce(DataFrame.unionByName, cold).select(F.lit("cold").alias("output"), F.col("tenant_id").alias("key"), F.col("log_id").alias("value"))
    return bus.unionByName(dead).unionByName(hot).unionByName(cold)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalise": q_normalise,
    "dedup_ttl": q_dedup_ttl,
    "evaluate_rules": q_evaluate_rules,
    "rule_windows": q_rule_windows,
    "alerts_first": q_alerts_first,
    "alerts_aligned": q_alerts_aligned,
    "search_one": q_search_one,
    "search_hot": q_search_hot,
    "search_cold": q_search_cold,
    "route_tier": q_route_tier,
    "search_pages": q_search_pages,
    "search_totals": q_search_totals,
    "upsert_hot": q_upsert_hot,
    "route_keys": q_route_keys,
    "parse_lines": q_parse_lines,
    "assemble_batches": q_assemble_batches,
    "stamp_ingest": q_stamp_ingest,
    "decode_batches": q_decode_batches,
    "dead_letter": q_dead_letter,
    "authorize": q_authorize,
    "authorize_rejected": q_authorize_rejected,
    "throttle": q_throttle,
    "session_counter": q_session_counter,
    "running_counter": q_running_counter,
    "tail_fanout": q_tail_fanout,
    "tail_frames": q_tail_frames,
    "archive_roundtrip": q_archive_roundtrip,
    "log_pipeline": q_pipeline,
    "hot_generations": q_hot_generations,
    "match_many": q_match_many,
    "throttle_overload": q_throttle_overload,
    "dedup_batches": q_dedup_batches,
    "gateway": q_gateway,
    "search_tiers": q_search_tiers,
    "search_deep": q_search_deep,
    "cold_hours": q_cold_hours,
    "normalized": q_normalized,
    "spool_replay": q_spool_replay,
    "file_lines": q_file_lines,
    "stream_outputs": q_stream_outputs,
}
