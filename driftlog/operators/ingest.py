"""Agent and gateway side: lines -> entries, entries -> batches, auth, stamping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.functions.ids import log_id
from driftlog.functions.keys import partition_key
from driftlog.functions.levels import extract_level
from driftlog.operators.numbering import number_within
from driftlog.schemas import ENTRY_COLUMNS

# Fixed value: the agent's default batch size.
DEFAULT_BATCH_SIZE = 100
# An API-key table is broadcast only up to this many rows; beyond, a shuffle join.
MAX_BROADCAST_KEYS = 1_000_000


def parse_lines(lines: DataFrame, tenant_id: str, service: str, host: str, environment: str,
                line_col: str = "line", agent_col: str = "agent_id", ts_col: str = "ts") -> DataFrame:
    """One entry per raw line: constants, extracted level, both times = the line's time, id.

    The id hashes agent + line + event time, so it is deterministic once the
    time is data (the live agent used its wall clock).
    """
    ts = F.col(ts_col)
    return lines.select(
        *[c for c in lines.columns if c not in ENTRY_COLUMNS],
        log_id(F.col(agent_col), F.col(line_col), ts).alias("log_id"),
        F.lit(tenant_id).alias("tenant_id"),
        F.lit(service).alias("service"),
        F.lit(host).alias("host"),
        F.lit("").alias("container"),
        F.lit(environment).alias("environment"),
        extract_level(F.col(line_col)).alias("level"),
        F.col(line_col).alias("message"),
        F.lit("").alias("trace_id"),
        F.lit("").alias("request_id"),
        ts.alias("event_timestamp"),
        ts.alias("ingest_timestamp"),
        F.create_map().cast("map<string,string>").alias("fields"),
    )


def assemble_batches(entries: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE, agent_col: str = "agent_id",
                     order: Sequence[str] = ("event_timestamp", "log_id"), sent_at: Column | None = None) -> DataFrame:
    """Group each agent's entries, in order, into batches of at most ``batch_size``.

    Batch number = floor((row_number - 1) / n) per agent; the array per batch is
    bounded by n, so no group grows with the data.
    """
    entry_struct = F.struct(*[F.col(c) for c in ENTRY_COLUMNS])
    numbered = number_within(entries, [agent_col], list(order), out="__rn").withColumn(
        "batch_no", F.floor((F.col("__rn") - 1) / F.lit(batch_size)).cast("long"))
    batches = numbered.groupBy(agent_col, "batch_no").agg(
        F.array_sort(F.collect_list(F.struct(F.col("__rn"), entry_struct.alias("e"))),
                     lambda a, b: F.signum(a["__rn"] - b["__rn"]).cast("int")).alias("__items"),
    )
    return batches.select(
        F.col(agent_col).alias("agent_id"), "batch_no",
        F.transform("__items", lambda it: it["e"]).alias("entries"),
        (sent_at if sent_at is not None else F.current_timestamp()).alias("sent_at"),
    )


def authorize(requests: DataFrame, keys: DataFrame, tenant_col: str = "tenant_id",
              key_col: str = "api_key") -> tuple[DataFrame, DataFrame]:
    """(admitted, rejected): tenant must be non-empty; an empty key table admits every tenant;
    otherwise (tenant, key) must match exactly."""
    has_tenant = F.coalesce(F.col(tenant_col), F.lit("")) != ""
    n_keys = keys.count()  # one job: the empty-table rule and the size check before broadcasting
    if n_keys == 0:
        return requests.filter(has_tenant), requests.filter(~has_tenant)
    k = keys.select(F.col("tenant_id").alias("__kt"), F.col("api_key").alias("__kk")).dropDuplicates(["__kt"])
    if n_keys <= MAX_BROADCAST_KEYS:
        k = F.broadcast(k)
    cond = (F.col(tenant_col) == F.col("__kt")) & (F.col(key_col) == F.col("__kk")) & has_tenant
    admitted = requests.join(k, cond, "left_semi")
    rejected = requests.join(k, cond, "left_anti")
    return admitted, rejected


def stamp_ingest(batches: DataFrame, tenant_col: str = "tenant_id", now: Column | None = None) -> DataFrame:
    """Overwrite every entry's tenant with the authenticated one and its ingest time with one
    instant for the whole request; add the bus key (tenant | first entry's service).
    An empty batch has no first entry and yields no row."""
    ts = now if now is not None else F.current_timestamp()
    stamped = batches.withColumn(
        "entries",
        F.transform("entries", lambda e: e.withField("tenant_id", F.col(tenant_col)).withField("ingest_timestamp", ts)),
    )
    return stamped.filter(F.size("entries") > 0).withColumn(
        "key", partition_key(F.col(tenant_col), F.element_at("entries", 1)["service"]))
