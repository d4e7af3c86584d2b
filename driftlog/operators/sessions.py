"""Idle-reset counters: a count per key that restarts once the key has been idle longer than ``gap``.

Every increment renews the expiry, so a counter lives as long as each event
arrives no later than ``gap`` after the previous one: that is a session
window. A key expires only when the clock is *past* its expiry instant, so an
event exactly ``gap`` after the previous one still counts in the same session
(Spark's session_window merges at equality too).

Plan (exact, and a hot key never reaches one task as rows): cut time into
buckets of width ``gap``. Two events in one bucket are less than ``gap``
apart, so a bucket never splits a session. A grouped aggregate reduces every
(key, bucket) to (first, last, count), combined map-side before the shuffle.
Sessions are then chained over those bucket summaries, whose number per key
is bounded by its time span / gap, not by its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _bucket_sessions(events: DataFrame, keys: list[str], ts: str, gap_us: int) -> DataFrame:
    """(keys, __b, __first, __last, __n, __sid): one row per non-empty gap-wide bucket."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    x = events.select(*keys, us.alias("__us")).filter(F.col("__us").isNotNull())
    buckets = x.groupBy(*keys, F.floor(F.col("__us") / F.lit(gap_us)).alias("__b")).agg(
        F.min("__us").alias("__first"), F.max("__us").alias("__last"), F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys).orderBy("__b")
    prev_last = F.lag("__last").over(w)
    starts = buckets.withColumn(
        "__new", F.when(prev_last.isNull() | ((F.col("__first") - prev_last) > gap_us), 1).otherwise(0))
    return starts.withColumn("__sid", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def _join_null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner equi-join in which a null key equals a null key; the right side's key columns go."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on])
    return left.join(renamed, same).drop(*[f"__r_{c}" for c in on])


def session_counter(events: DataFrame, keys: Sequence[str], ts: str, gap_seconds: int) -> DataFrame:
    """One row per (key, session): session_start, session_end (last event + gap), count."""
    keys = list(keys)
    gap_us = int(gap_seconds) * 1_000_000
    sid = _bucket_sessions(events, keys, ts, gap_us)
    agg = sid.groupBy(*keys, "__sid").agg(
        F.min("__first").alias("__s"), F.max("__last").alias("__e"), F.sum("__n").alias("count"))
    return agg.select(*keys, F.timestamp_micros(F.col("__s")).alias("session_start"),
                      F.timestamp_micros(F.col("__e") + gap_us).alias("session_end"),
                      F.col("count").cast("long").alias("count"))


def running_counter(events: DataFrame, keys: Sequence[str], ts: str, gap_seconds: int,
                    order: Sequence[str] = ()) -> DataFrame:
    """Every event with ``counter``: the value after its increment (1 after an idle gap),
    and ``session_start``. Events map to sessions through their bucket (an equi-join on
    (key, bucket)), then are numbered within the session by ``number_within``, which
    spreads a hot session over many tasks."""
    from driftlog.operators.numbering import number_within  # noqa: PLC0415

    keys = list(keys)
    gap_us = int(gap_seconds) * 1_000_000
    sid = _bucket_sessions(events, keys, ts, gap_us)
    starts = sid.groupBy(*keys, "__sid").agg(F.min("__first").alias("__s"))
    bucket_to_session = _join_null_safe(sid, starts, [*keys, "__sid"]).select(*keys, "__b", "__s")
    x = events.withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp"))).filter(F.col("__us").isNotNull())
    x = _join_null_safe(x.withColumn("__b", F.floor(F.col("__us") / F.lit(gap_us))), bucket_to_session, [*keys, "__b"])
    n = number_within(x, [*keys, "__s"], ["__us", *order], out="counter")
    return n.withColumn("session_start", F.timestamp_micros(F.col("__s"))).drop("__us", "__b", "__s")
