"""Streaming token bucket and idle-reset counter with ``transformWithStateInPandas``.

Each key keeps one small value (tokens and last time; count, session start and last time). A micro-batch brings a
key's rows as frames; the fold is the batch operators' own, started from the kept value, so the stream equals the
batch however the input is split into micro-batches, as long as they come in order of time.

With ``retention_seconds`` a value that has not been touched for that much wall clock goes: a bucket by the state's
time to live, a counter by a timer that each micro-batch of the key sets anew. Spark then goes on making
micro-batches without input, so such a query suits a continuous trigger; without retention ``availableNow`` ends.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from driftlog.operators.throttle import bucket_fold
from driftlog.session import ship_package

# no leading underscores: the state frames rename such columns
_T, _UNTIMED = "keyed_time_us", "keyed_untimed"


def _sorted(rows: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values([_T, *order], kind="stable", ignore_index=True)


class BucketProcessor(StatefulProcessor):
    """Admitted and tokens left of one tenant's requests."""

    def __init__(self, rps: float, order: Sequence[str], retention_ms: int | None):
        self.rps, self.order, self.retention_ms = rps, list(order), retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bucket = handle.getValueState("bucket", "tokens double, last long", ttlDurationMs=self.retention_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self.order)
        carry = tuple(self.bucket.get()) if self.bucket.exists() else None
        t = pdf[_T].to_numpy(np.int64)
        timed = ~pdf[_UNTIMED].to_numpy(bool)
        admitted, left = np.ones(len(t), bool), np.full(len(t), np.nan)
        if timed.any():
            first = [False] * int(timed.sum())
            a, b, carry = bucket_fold(t[timed].tolist(), first, self.rps, carry)
            admitted[timed], left[timed] = a, b
            self.bucket.update((float(carry[0]), int(carry[1])))
        pdf["admitted"], pdf["tokens_left"] = admitted, left
        yield pdf

    def close(self) -> None:
        pass


class CounterProcessor(StatefulProcessor):
    """Running counter of one key, starting again after a pause of more than ``gap_us``."""

    def __init__(self, gap_us: int, order: Sequence[str], retention_ms: int | None):
        self.gap_us, self.order, self.retention_ms = gap_us, list(order), retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.session = handle.getValueState("session", "count long, start long, last long")
        self.due = handle.getValueState("due", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self.order)
        t = pdf[_T].to_numpy(np.int64)
        count, start, last = self.session.get() if self.session.exists() else (0, int(t[0]), None)
        new = np.empty(len(t), bool)
        new[1:] = np.diff(t) > self.gap_us
        new[0] = last is not None and t[0] - last > self.gap_us
        place = np.arange(len(t))
        head = np.maximum.accumulate(np.where(new, place, -1))  # the place where a row's session begins, if here
        pdf["counter"] = np.where(head >= 0, place - head + 1, count + place + 1)
        pdf["session_start"] = pd.to_datetime(np.where(head >= 0, t[np.maximum(head, 0)], start), unit="us", utc=True)
        self.session.update((int(pdf["counter"].iloc[-1]), int(t[head[-1]]) if head[-1] >= 0 else int(start), int(t[-1])))
        if self.retention_ms is not None:
            if self.due.exists():
                self.handle.deleteTimer(self.due.get()[0])
            at = timerValues.getCurrentProcessingTimeInMs() + self.retention_ms
            self.handle.registerTimer(at)
            self.due.update((at,))
        yield pdf

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # the key has been silent for the retention time: forget it
        self.session.clear()
        self.due.clear()
        yield from ()

    def close(self) -> None:
        pass


def _keyed(rows: DataFrame) -> tuple[DataFrame, bool]:
    ship_package(rows.sparkSession)
    has_fields = "fields" in rows.columns
    x = rows.withColumn("fields", F.to_json("fields")) if has_fields else rows
    return x, has_fields


def _ms(seconds: float | None) -> int | None:
    return None if seconds is None else int(seconds * 1000)


def _mode(seconds: float | None) -> str:
    return "None" if seconds is None else "ProcessingTime"


def throttle_stream(requests: DataFrame, rps: float, tenant_col: str = "tenant_id", ts_col: str = "ts",
                    order: Sequence[str] = (), retention_seconds: float | None = None) -> DataFrame:
    """Streaming ``throttle``: ``admitted`` and ``tokens_left`` of every request, with the batch operator's bits."""
    x, has_fields = _keyed(requests)
    micros = F.unix_micros(F.col(ts_col).cast("timestamp"))
    x = x.withColumns({_T: F.coalesce(micros, F.lit(0)), _UNTIMED: micros.isNull()})
    schema = T.StructType([*x.schema.fields, T.StructField("admitted", T.BooleanType()), T.StructField("tokens_left", T.DoubleType())])
    out = x.groupBy(tenant_col).transformWithStateInPandas(
        BucketProcessor(float(rps), order, _ms(retention_seconds)), schema, "append", _mode(retention_seconds))
    out = out.withColumn("tokens_left", F.when(~F.col(_UNTIMED), F.col("tokens_left"))).drop(_T, _UNTIMED)
    return _unjson(out, has_fields)


def running_counter_stream(entries: DataFrame, keys: Sequence[str], ts_col: str, gap_seconds: float,
                           order: Sequence[str] = (), retention_seconds: float | None = None) -> DataFrame:
    """Streaming ``running_counter``: ``counter`` and ``session_start`` of every entry that has a time."""
    x, has_fields = _keyed(entries)
    x = x.withColumn(_T, F.unix_micros(F.col(ts_col))).where(F.col(_T).isNotNull())
    schema = T.StructType([*x.schema.fields, T.StructField("counter", T.LongType()), T.StructField("session_start", T.TimestampType())])
    out = x.groupBy(*keys).transformWithStateInPandas(
        CounterProcessor(int(gap_seconds * 1_000_000), order, _ms(retention_seconds)), schema, "append", _mode(retention_seconds))
    return _unjson(out.drop(_T), has_fields)


def _unjson(out: DataFrame, has_fields: bool) -> DataFrame:
    return out.withColumn("fields", F.from_json("fields", T.MapType(T.StringType(), T.StringType()))) if has_fields else out
