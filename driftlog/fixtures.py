"""Test inputs derived from the driver's tables (see FIXTURES.md).

Each builder is a Spark plan over the parquet tables, so its size grows with
them. The matching DuckDB text lives in ``driftlog.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftlog.functions.jsonx import json_quote
from driftlog.schemas import API_KEY, RULE, SEARCH_REQUEST, SUBSCRIPTION

# Fixed values (FIXTURES.md B1): replays as (shift seconds, every m-th event).
REPLAYS = [(0, 1), (120, 20), (300, 77), (600, 33)]
# Fixed values (FIXTURES.md B1): level text per event type; anything else is ''.
LEVEL_BY_TYPE = {"error": "\terror ", "purchase": "Warn", "view": "info", "click": "debug"}

# Fixed values (FIXTURES.md B2): alert rules.
RULES = [
    ("high-error-rate", "*", "ERROR", "", 3, 21600, "http://hooks.local/errors"),
    ("purchase-seen", "*", "", "PURCHASE K=1", 1, 3600, "http://hooks.local/sales"),
    ("tenant1-busy", "tenant-1", "", "", 5, 3600, "http://hooks.local/busy"),
    ("every-event", "*", "", "", 0, 600, "http://hooks.local/all"),
]

# Fixed values (FIXTURES.md B3): API keys; tenant-3 has none.
API_KEYS = [("tenant-0", "k0"), ("tenant-1", "k1"), ("tenant-2", "k2")]

# Fixed values (FIXTURES.md B3): live-tail subscriptions ('' = any).
SUBSCRIPTIONS = [
    ("s1", "tenant-0", "", ""),
    ("s2", "tenant-0", "error", ""),
    ("s3", "tenant-1", "", "warn"),
    ("s4", "tenant-1", "view", "INFO"),
    ("s5", "tenant-9", "", ""),
]

# Fixed values (FIXTURES.md B3): raw-line prefixes chosen by (doc_id + pos) % 8.
LINE_PREFIXES = ["[ERROR] ", "warn: ", "Info ", "debug ", "[FATAL] ",
                 "[FATAL] unrecoverable error ", "terror ", ""]

# Fixed values (FIXTURES.md B3): search requests over the log_entries fixture
# (id, tenant, service, level, q, from, to, page, page_size).
SEARCH_REQUESTS = [
    ("by-level", "tenant-0", "", "ERROR", "", "2024-01-01T00:00:00Z", "2024-01-31T00:00:00Z", "1", "100"),
    ("by-service", "tenant-1", "view", "", "", "2024-01-01T00:00:00Z", "2024-01-31T00:00:00Z", "1", "100"),
    ("by-text", "tenant-2", "", "", "k=7 k=42", "2024-01-01T00:00:00Z", "2024-01-31T00:00:00Z", "1", "100"),
    ("page-2-of-50", "tenant-3", "", "", "", "2024-01-01T00:00:00Z", "2024-01-31T00:00:00Z", "2", "50"),
    ("past-the-end", "tenant-0", "click", "DEBUG", "", "2024-01-01T00:00:00Z", "2024-01-31T00:00:00Z", "999", "100"),
    ("size-9999", "tenant-1", "", "", "", "2024-01-10T00:00:00Z", "2024-01-12T00:00:00Z", "1", "9999"),
    ("size-0", "tenant-1", "", "", "", "2024-01-10T00:00:00Z", "2024-01-12T00:00:00Z", "1", "0"),
    ("size-abc", "tenant-2", "", "", "", "2024-01-10T00:00:00Z", "2024-01-12T00:00:00Z", "abc", "abc"),
    ("from-after-to", "tenant-0", "", "", "", "2024-01-20T00:00:00Z", "2024-01-10T00:00:00Z", "1", "100"),
    ("fractions", "tenant-3", "", "WARN", "", "2024-01-05T10:00:00.900Z", "2024-01-06T10:00:00.999Z", "1", "100"),
    ("bad-times", "tenant-0", "", "", "", "yesterday", "2024-13-45", "1", "100"),
    ("at-cutoff", "tenant-2", "", "", "", "2023-12-31T00:00:00Z", "2024-01-31T00:00:00Z", "1", "100"),
    ("cold-old", "tenant-1", "", "INFO", "", "2023-06-01T00:00:00Z", "2024-01-03T00:00:00Z", "1", "20"),
]
# Text of one spool file, about (its last entry may be longer), and what an entry's other fields take.
SPOOL_BYTES, SPOOL_ENTRY_BYTES = 1 << 20, 128
# Fixed value: the clock the search fixtures are routed with (hot cutoff = now - 30 days).
SEARCH_NOW = "2024-01-30T00:00:00Z"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with ts as a UTC TIMESTAMP (it is stored as TIMESTAMP_NTZ)."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


def log_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: one entry per event plus replays; keeps ``shift`` and ``event_id`` as tie-breaks."""
    ev = events(spark, sf_dir)
    # each event fans out to the replays that select it (no join: a filtered constant array)
    replays = F.array(*[F.struct(F.lit(s).alias("shift"), F.lit(m).alias("m")) for s, m in REPLAYS])
    x = ev.withColumn("__r", F.explode(F.filter(replays, lambda r: (F.col("event_id") % r["m"]) == 0))) \
        .withColumn("shift", F.col("__r.shift")).drop("__r")
    k = F.get_json_object("props", "$.k")
    level = F.lit("")
    for etype, text in reversed(list(LEVEL_BY_TYPE.items())):
        level = F.when(F.col("event_type") == etype, F.lit(text)).otherwise(level)
    eid = F.col("event_id")
    return x.select(
        F.when(eid % 89 == 0, F.lit("")).otherwise(F.concat(F.lit("e"), eid.cast("string"))).alias("log_id"),
        F.when(eid % 97 == 0, F.lit("")).otherwise(
            F.concat(F.lit("tenant-"), (F.col("user_id") % 4).cast("string"))).alias("tenant_id"),
        F.col("event_type").alias("service"),
        F.concat(F.lit("h"), (F.col("user_id") % 10).cast("string")).alias("host"),
        F.lit("").alias("container"),
        F.lit("test").alias("environment"),
        level.alias("level"),
        F.when(eid % 101 == 0, F.lit("")).otherwise(
            F.concat(F.col("event_type"), F.lit(" k="), k)).alias("message"),
        F.lit("").alias("trace_id"),
        F.lit("").alias("request_id"),
        F.when(eid % 13 == 0, F.lit(None).cast("timestamp")).otherwise(F.col("ts")).alias("event_timestamp"),
        F.timestamp_micros(F.unix_micros("ts") + ((eid % 30) + F.col("shift")) * 1_000_000).alias("ingest_timestamp"),
        F.create_map(F.lit("k"), k).alias("fields"),
        F.col("shift"),
        eid.alias("event_id"),
    )


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, RULE)


def many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule per order: needle ``K=<key>`` (few keys occur in messages), every fifth for all tenants, levels in turn."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("o"), key.cast("string")).alias("name"),
        F.when(key % 5 == 0, F.lit("*")).otherwise(F.concat(F.lit("tenant-"), (F.col("o_custkey") % 4).cast("string"))).alias("tenant_id"),
        F.when(key % 3 == 0, F.lit("error")).when(key % 3 == 1, F.lit("Info")).otherwise(F.lit("")).alias("level"),
        F.concat(F.lit(" K="), key.cast("string")).alias("message_contains"),
        F.lit(1).alias("threshold"), F.lit(600).alias("window_seconds"), F.lit("").alias("webhook"),
        key.cast("long").alias("rule_pos"),
    )


def api_keys(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(API_KEYS, API_KEY)


def subscriptions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SUBSCRIPTIONS, SUBSCRIPTION)


def search_requests(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEARCH_REQUESTS, SEARCH_REQUEST)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3: one request per event; tenant = user_id % 4, ts = event_id x 20 ms; key wrong every 10th."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    tenant_no = (F.col("user_id") % 4).cast("string")
    return ev.select(
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("request_id"),
        F.concat(F.lit("tenant-"), tenant_no).alias("tenant_id"),
        F.when(F.col("event_id") % 10 == 0, F.lit("wrong")).otherwise(F.concat(F.lit("k"), tenant_no)).alias("api_key"),
        F.timestamp_micros(F.col("event_id") * 20_000).alias("ts"),
        F.col("event_id"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3: documents split into lines (whole texts), each given a level-bearing prefix."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "body"))
    sel = (F.col("doc_id") + F.col("pos")) % 8
    prefix = F.lit("")
    for i, p in reversed(list(enumerate(LINE_PREFIXES))):
        prefix = F.when(sel == i, F.lit(p)).otherwise(prefix)
    return lines.select(
        "doc_id", "pos",
        F.concat(F.lit("a"), F.col("doc_id").cast("string")).alias("agent_id"),
        F.concat(prefix, F.col("body")).alias("line"),
        # a deterministic event time per line: 2024-01-01 + doc_id minutes + pos ms
        F.timestamp_micros(F.lit(1704067200_000000) + F.col("doc_id") * 60_000_000 + F.col("pos") * 1000).alias("ts"),
    )


# Fixed values (FIXTURES.md C1): edge-case batch texts, as (edge id, text).
_ENTRY_OK = ('{"log_id":"edge-ok","tenant_id":"tenant-0","service":"svc","level":" warn\\u00a0",'
             '"message":"ok","event_timestamp":"2024-01-02T03:04:05.123456789+05:30","fields":{"a":"b","c":null}}')
EDGE_BATCHES = [
    ("c01", ""),
    ("c02", "not-json"),
    ("c03", "null"),
    ("c04", "{}"),
    ("c05", "[]"),
    ("c06", '"x"'),
    ("c07", "5"),
    ("c08", '{"entries":null}'),
    ("c09", '{"entries":[null]}'),
    ("c10", '{"entries":{}}'),
    ("c11", '{"entries":[5]}'),
    ("c12", '{"entries":[{"message":5}]}'),
    ("c13", '{"entries":[{"fields":{"a":1}}]}'),
    ("c14", '{"unknown":1,"entries":[' + _ENTRY_OK + "]}"),
    ("c15", "{} x"),
    ("c16", "{}{}"),
    ("c17", "{},{}"),
    ("c18", "{}] x"),
    ("c19", "{}} x"),
    ("c20", '{"a":1,"a":2}'),
    ("c21", '{"entries":[{"log_id":"edge-zero","tenant_id":"tenant-1","message":"z",'
            '"event_timestamp":"0001-01-01T00:00:00Z","ingest_timestamp":"2024-01-05T00:00:00Z"}]}'),
    ("c22", '{"entries":[{"event_timestamp":"2026-04-26"}]}'),
    ("c23", '{"entries":[{"event_timestamp":"2026-04-26 10:00:00Z"}]}'),
    ("c24", '{"entries":[{"event_timestamp":"garbage"}]}'),
    ("c25", '{"entries":[{"log_id":"edge-blank","tenant_id":"tenant-2","message":" ",'
            '"ingest_timestamp":"2024-01-05T00:00:00Z"},{"log_id":"edge-notenant","message":"m"}]}'),
]


def raw_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3: one JSON batch per conversation (chunks of 100 turns) plus the C1 edge texts.

    Columns: batch_id, value (JSON text).
    """
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    base = F.lit(1704067200_000000) + F.col("conv_id") * 60_000_000 + F.col("turn") * 1_000_000
    fmt = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    entry = F.struct(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("log_id"),
        F.concat(F.lit("tenant-"), (F.col("conv_id") % 4).cast("string")).alias("tenant_id"),
        F.col("role").alias("service"),
        F.lit("h1").alias("host"),
        F.lit("test").alias("environment"),
        F.when(F.col("role") == "user", F.lit("info")).otherwise(F.lit("debug")).alias("level"),
        F.col("text").alias("message"),
        F.date_format(F.timestamp_micros(base), fmt).alias("event_timestamp"),
        F.date_format(F.timestamp_micros(base + 1_000_000), fmt).alias("ingest_timestamp"),
    )
    chunk = F.floor(F.col("turn") / 100)
    grouped = conv.groupBy("conv_id", chunk.alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("turn"), entry.alias("e")))).alias("items"))
    batches = grouped.select(
        F.concat(F.lit("b"), F.col("conv_id").cast("string"), F.lit("-"), F.col("chunk").cast("string")).alias("batch_id"),
        F.to_json(F.struct(
            F.concat(F.lit("a"), F.col("conv_id").cast("string")).alias("agent_id"),
            F.transform("items", lambda it: it["e"]).alias("entries"),
            F.lit("2024-02-01T00:00:00Z").alias("sent_at"),
        )).alias("value"),
    )
    edges = spark.createDataFrame(EDGE_BATCHES, "batch_id string, value string")
    return batches.unionByName(edges)


def damaged_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches damaged in ways that depend on the row: one conversation turn in ten, by (7 conv_id + turn) % 40:
    0 cut off, 1 a bad time, 2 a number for a string, 3 no tenant (decodes, but is rejected as an entry)."""
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    kind = (F.col("conv_id") * 7 + F.col("turn")) % 40
    text = json_quote(F.col("text"))
    name = F.concat(F.lit("d"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    body = (
        F.when(kind == 0, F.concat(F.lit('{"entries":[{"message":'), text))
        .when(kind == 1, F.concat(F.lit('{"entries":[{"message":'), text, F.lit(',"event_timestamp":"yesterday"}]}')))
        .when(kind == 2, F.concat(F.lit('{"entries":[{"tenant_id":7,"message":'), text, F.lit("}]}")))
        .otherwise(F.concat(F.lit('{"entries":[{"log_id":"'), name, F.lit('","message":'), text, F.lit("}]}")))
    )
    return conv.where(kind < 4).select(name.alias("batch_id"), body.alias("value"))


def gateway_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``requests`` with a body: one entry, every 12th two, every 11th cut off; the tenant in it is forged."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.col("event_type").alias("type"))
    entry = F.concat(F.lit('{"log_id":"e'), F.col("event_id").cast("string"), F.lit('","tenant_id":"forged","service":"'),
                     F.col("type"), F.lit('","message":"'), F.col("type"), F.lit('"}'))
    one = F.concat(F.lit('{"agent_id":"a","entries":['), entry)
    body = F.when(F.col("event_id") % 11 == 0, one).when(
        F.col("event_id") % 12 == 0, F.concat(one, F.lit(","), entry, F.lit("]}"))).otherwise(F.concat(one, F.lit("]}")))
    return requests(spark, sf_dir).join(ev.select("event_id", body.alias("body")), "event_id")


def spool_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole batches for files: all turns of the conversations of one remainder modulo 61, in order, cut into
    batches of about SPOOL_BYTES of text. ``start``: turns of that remainder before the batch."""
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    entry = F.struct(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("log_id"),
        F.concat(F.lit("tenant-"), (F.col("conv_id") % 4).cast("string")).alias("tenant_id"),
        F.col("role").alias("service"), F.col("text").alias("message"))
    turns = conv.select((F.col("conv_id") % 61).alias("part"), "conv_id", "turn", entry.alias("e")).where("part is not null")
    order = Window.partitionBy("part").orderBy("conv_id", "turn", "e")
    size = F.octet_length(F.coalesce(F.col("e.message"), F.lit(""))) + SPOOL_ENTRY_BYTES
    before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = turns.select("part", "e", (F.row_number().over(order) - 1).cast("long").alias("n"), F.floor(before / SPOOL_BYTES).alias("chunk"))
    items = F.sort_array(F.collect_list(F.struct("n", "e")))
    per = cut.groupBy("part", "chunk").agg(F.min("n").alias("start"), items.alias("items"))
    return per.select("part", "start", F.to_json(F.struct(F.lit("spool").alias("agent_id"), F.transform("items", lambda x: x["e"]).alias("entries"))).alias("value"))


def daily_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search request per (tenant, UTC day) present in events; the day of month picks
    the variant (level / service / text / page 2 / oversized page / bad times)."""
    ev = events(spark, sf_dir)
    days = ev.select(F.concat(F.lit("tenant-"), (F.col("user_id") % 4).cast("string")).alias("tenant_id"),
                     F.to_date("ts").alias("day")).distinct()
    dom = F.dayofmonth("day")
    v = dom % 5
    day_txt = F.date_format("day", "yyyy-MM-dd")
    nxt_txt = F.date_format(F.date_add("day", 1), "yyyy-MM-dd")
    frm = F.when(dom % 7 == 0, F.lit("yesterday")).otherwise(F.concat(day_txt, F.lit("T00:00:00.900Z")))
    to = F.when(dom % 11 == 0, F.lit("garbage")).otherwise(F.concat(nxt_txt, F.lit("T06:00:00Z")))
    return days.select(
        F.concat(F.col("tenant_id"), F.lit("@"), day_txt).alias("request_id"),
        "tenant_id",
        F.when(v == 1, F.lit("view")).otherwise(F.lit("")).alias("service"),
        F.when(v == 0, F.lit("ERROR")).otherwise(F.lit("")).alias("level"),
        F.when(v == 2, F.lit("k=7 k=42")).otherwise(F.lit("")).alias("q"),
        frm.alias("from"),
        to.alias("to"),
        F.when(v == 3, F.lit("2")).when(dom % 13 == 0, F.lit("abc")).otherwise(F.lit("1")).alias("page"),
        F.when(v == 3, F.lit("50")).when(v == 4, F.lit("9999")).when(dom % 9 == 0, F.lit("0"))
        .otherwise(F.lit("20")).alias("page_size"),
    )
