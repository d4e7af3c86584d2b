"""Record shapes shared by all operators (one log entry, a batch of them, bus rows, dimensions)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# Field order of one log entry; optional strings are '' inside the engine and
# only dropped (NULL) when an entry is encoded to JSON.
ENTRY_STRING_FIELDS = [
    "log_id", "tenant_id", "service", "host", "container", "environment",
    "level", "message", "trace_id", "request_id",
]
OPTIONAL_STRING_FIELDS = ["container", "trace_id", "request_id"]
ENTRY_TIME_FIELDS = ["event_timestamp", "ingest_timestamp"]
ENTRY_COLUMNS = ENTRY_STRING_FIELDS + ENTRY_TIME_FIELDS + ["fields"]

LOG_ENTRY = T.StructType(
    [T.StructField(n, S) for n in ENTRY_STRING_FIELDS]
    + [T.StructField(n, T.TimestampType()) for n in ENTRY_TIME_FIELDS]
    + [T.StructField("fields", T.MapType(S, S))]
)

LOG_BATCH = T.StructType([
    T.StructField("agent_id", S),
    T.StructField("entries", T.ArrayType(LOG_ENTRY)),
    T.StructField("sent_at", T.TimestampType()),
])

# Kafka-source row shape; file sources in tests produce the same columns.
BUS_MESSAGE = T.StructType([
    T.StructField("topic", S),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
])

DEAD_LETTER = T.StructType([T.StructField("reason", S), T.StructField("payload", S)])

RULE = T.StructType([
    T.StructField("name", S),
    T.StructField("tenant_id", S),
    T.StructField("level", S),
    T.StructField("message_contains", S),
    T.StructField("threshold", T.IntegerType()),
    T.StructField("window_seconds", T.IntegerType()),
    T.StructField("webhook", S),
])

ALERT = T.StructType([
    T.StructField("rule", S),
    T.StructField("tenant_id", S),
    T.StructField("service", S),
    T.StructField("count", T.LongType()),
    T.StructField("fired_at", T.TimestampType()),
    T.StructField("sample_message", S),
    T.StructField("webhook", S),
])

API_KEY = T.StructType([T.StructField("tenant_id", S), T.StructField("api_key", S)])

SUBSCRIPTION = T.StructType([
    T.StructField("subscriber_id", S),
    T.StructField("tenant_id", S),
    T.StructField("service", S),
    T.StructField("level", S),
])

SEARCH_REQUEST = T.StructType([
    T.StructField("request_id", S),
    T.StructField("tenant_id", S),
    T.StructField("service", S),
    T.StructField("level", S),
    T.StructField("q", S),
    T.StructField("from", S),
    T.StructField("to", S),
    T.StructField("page", S),
    T.StructField("page_size", S),
])
