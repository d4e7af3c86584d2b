"""Live tail: deliver each entry to the subscribers of its tenant, with optional filters.

Subscriptions are a small dimension (bounded by the live-session limit) and
are broadcast after a size check; past the bound they join on tenant by shuffle. A subscriber's buffer holds ``cap`` entries
per delivery round: entries past it are dropped *before* the service/level
filter, as a full buffer drops whatever arrives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlog.operators.decode import encode_entry

# Fixed value: per-subscriber buffer size.
BUFFER_SIZE = 64
MAX_SUBSCRIPTIONS = 100_000


def tail_fanout(entries: DataFrame, subscriptions: DataFrame, cap: int | None = BUFFER_SIZE,
                round_col: str | None = None, order: Sequence[str | Column] = ("ingest_timestamp", "log_id")) -> DataFrame:
    """One row per (subscriber, delivered entry) with the event-stream frame ``data: <json>\\n\\n``.

    Matching: tenant equal (hash key of the broadcast join); service equal when
    the subscription gives one; the entry level equal to the *uppercased*
    subscription level when given (the entry level itself is not folded).
    ``cap``: at most that many tenant-matched entries per subscriber and
    delivery round (``round_col``, e.g. the micro-batch), counted in ``order``.
    """
    subs = subscriptions.select(
        "subscriber_id", F.col("tenant_id").alias("s_tenant"),
        F.coalesce(F.col("service"), F.lit("")).alias("s_service"),
        F.upper(F.coalesce(F.col("level"), F.lit(""))).alias("s_level"))
    if subscriptions.count() <= MAX_SUBSCRIPTIONS:  # size check; beyond it a shuffle join on tenant
        subs = F.broadcast(subs)
    x = entries.join(subs, F.col("tenant_id") == F.col("s_tenant"), "inner")
    if cap is not None:
        part = ["subscriber_id"] + ([round_col] if round_col else [])
        w = Window.partitionBy(*part).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order])
        x = x.withColumn("__slot", F.row_number().over(w)).filter(F.col("__slot") <= cap).drop("__slot")
    x = x.filter(((F.col("s_service") == "") | (F.col("service") == F.col("s_service")))
                 & ((F.col("s_level") == "") | (F.col("level") == F.col("s_level"))))
    return x.withColumn("frame", F.concat(F.lit("data: "), encode_entry(), F.lit("\n\n"))).drop(
        "s_tenant", "s_service", "s_level")
