"""Per-tenant token bucket over a request log.

The bucket starts full (capacity = rps). Each request refills elapsed x rps,
capped at rps, then is admitted iff at least one token is left (and takes it).
A denied request still moves the last-seen time. Float operations follow that
order exactly so results are bit-identical to a sequential reference.

Plan: hash shuffle on tenant, sort inside partitions, then a ``mapInArrow``
fold carrying (tenant, tokens, last seen) across Arrow batches. After a gap
of at least one second the bucket is full whatever came before, so those
points restart the fold without history.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlog.operators.anchored import _key_change
from driftlog.session import ship_package

NANOS_PER_SECOND = 1_000_000_000


def elapsed_seconds(delta_micros: int) -> float:
    """Seconds of a duration the way a nanosecond duration converts: whole + fraction / 1e9."""
    d = delta_micros * 1000
    sec, nsec = divmod(d, NANOS_PER_SECOND)
    if d < 0 and nsec:
        sec, nsec = sec + 1, nsec - NANOS_PER_SECOND  # truncation toward zero
    return float(sec) + float(nsec) / 1e9


def bucket_fold(ts: list[int], key_start: list[bool], rps: float, carry: tuple | None):
    """Admitted flags and remaining tokens for sorted request times (micros)."""
    cap = float(rps)
    admitted = [False] * len(ts)
    left = [0.0] * len(ts)
    tokens, last = (carry if carry is not None else (cap, None))
    for i, t in enumerate(ts):
        if key_start[i] or last is None:
            tokens, last = cap, t
        tokens += elapsed_seconds(t - last) * cap
        if tokens > cap:
            tokens = cap
        last = t
        if tokens >= 1:
            tokens -= 1
            admitted[i] = True
        left[i] = tokens
    return admitted, left, (tokens, last)


def _make_fold(key_names: list[str], rps: float):
    def fold(batches):
        prev_key = None
        carry = None
        for rb in batches:
            if rb.num_rows == 0:
                continue
            kcols = [rb.column(k) for k in key_names]
            ks = _key_change(kcols, prev_key)
            ts = rb.column("__tb_t").to_pylist()
            adm, left, carry = bucket_fold(ts, ks.tolist(), rps, carry if prev_key is not None else None)
            prev_key = tuple(c[-1].as_py() for c in kcols)
            out = rb.append_column("admitted", pa.array(adm, pa.bool_()))
            yield out.append_column("tokens_left", pa.array(left, pa.float64()))
    return fold


def throttle(requests: DataFrame, rps: float, tenant_col: str = "tenant_id", ts_col: str = "ts",
             order: Sequence[str | Column] = (), num_partitions: int | None = None,
             mode: str = "auto") -> DataFrame:
    """Add ``admitted`` (bool) and ``tokens_left`` (double) to each request.

    mode "range" spreads a tenant over many tasks (``throttle_range``), "hash"
    gives each tenant one streaming task, "auto" picks range for inputs
    estimated above ``spark.driftlog.rangeFoldMinBytes``.
    """
    from driftlog.session import fold_mode  # noqa: PLC0415

    resolved = fold_mode(requests, mode)
    # a request without a time cannot be measured: it is admitted, takes no token and has no tokens_left
    timed = F.col(ts_col).cast("timestamp").isNotNull()
    untimed = requests.filter(~timed).withColumns({"admitted": F.lit(True), "tokens_left": F.lit(None).cast("double")})
    folded = _throttle_timed(requests.filter(timed), rps, tenant_col, ts_col, order, num_partitions, resolved)
    return folded.unionByName(untimed)


def _throttle_timed(requests: DataFrame, rps: float, tenant_col: str, ts_col: str, order: Sequence[str | Column],
                    num_partitions: int | None, mode: str) -> DataFrame:
    if mode == "range":
        return throttle_range(requests, rps, tenant_col, ts_col, order, num_partitions)
    ship_package(requests.sparkSession)
    base = requests.columns
    x = requests.withColumn("__tb_t", F.unix_micros(F.col(ts_col).cast("timestamp")))
    x = x.repartition(num_partitions, F.col(tenant_col)) if num_partitions else x.repartition(F.col(tenant_col))
    x = x.sortWithinPartitions(F.col(tenant_col), F.col("__tb_t"),
                               *[F.col(o) if isinstance(o, str) else o for o in order])
    schema = T.StructType(list(x.schema.fields) + [
        T.StructField("admitted", T.BooleanType(), False),
        T.StructField("tokens_left", T.DoubleType(), False),
    ])
    y = x.mapInArrow(_make_fold([tenant_col], float(rps)), schema)
    return y.select(*base, "admitted", "tokens_left")


# ---- range mode: a hot tenant spread over many tasks ----------------------------------------

_PID = "__tb_pid"
THROTTLE_EDGES = T.StructType([
    T.StructField("pid", T.IntegerType()), T.StructField("first_key", T.StringType()),
    T.StructField("last_key", T.StringType()), T.StructField("single", T.BooleanType()),
    T.StructField("t_first", T.LongType()), T.StructField("has_reset", T.BooleanType()),
    T.StructField("exit_tokens", T.DoubleType()), T.StructField("exit_last", T.LongType()),
    T.StructField("fresh_tokens", T.DoubleType()), T.StructField("fresh_last", T.LongType()),
])


def _throttle_edges(key_names: list[str], rps: float):
    import json

    def fold(batches):
        pid = first = last_key = None
        prev = carry = None
        single, has_reset, t_first, last_t = True, False, None, None
        fresh = None  # the first key folded as if nothing came before
        for rb in batches:
            n = rb.num_rows
            if n == 0:
                continue
            if pid is None:
                pid = rb.column(_PID)[0].as_py()
            kcols = [rb.column(k) for k in key_names]
            ks = _key_change(kcols, prev)
            ts = rb.column("__tb_t").to_pylist()
            if first is None:
                first, ks[0], t_first = json.dumps([c[0].as_py() for c in kcols], default=str), True, ts[0]
            if single:
                # leading rows of this batch that still belong to the partition's first key
                later = np.flatnonzero(ks[1:]) + 1 if prev is None else np.flatnonzero(ks)
                head = int(later[0]) if later.size else n
                t_head = np.asarray(([last_t] if last_t is not None else []) + ts[:head], dtype=np.int64)
                if t_head.size > 1 and (np.diff(t_head) >= 1_000_000).any():
                    has_reset = True
                if head:
                    last_t = ts[head - 1]
                if head < n:
                    single = False
            _, _, carry = bucket_fold(ts, ks.tolist(), rps, carry if prev is not None else None)
            if single:
                fresh = carry
            prev = tuple(c[-1].as_py() for c in kcols)
            last_key = json.dumps([c[-1].as_py() for c in kcols], default=str)
        if pid is None:
            return
        yield pa.RecordBatch.from_pylist([{
            "pid": pid, "first_key": first, "last_key": last_key, "single": single, "t_first": t_first,
            "has_reset": has_reset, "exit_tokens": carry[0], "exit_last": carry[1],
            "fresh_tokens": fresh[0] if fresh else None, "fresh_last": fresh[1] if fresh else None}],
            schema=pa.schema([("pid", pa.int32()), ("first_key", pa.string()), ("last_key", pa.string()),
                              ("single", pa.bool_()), ("t_first", pa.int64()), ("has_reset", pa.bool_()),
                              ("exit_tokens", pa.float64()), ("exit_last", pa.int64()),
                              ("fresh_tokens", pa.float64()), ("fresh_last", pa.int64())]))
    return fold


def _throttle_apply(key_names: list[str], rps: float, entering_bc):
    def fold(batches):
        entering = entering_bc.value
        prev = carry = None
        started = False
        for rb in batches:
            if rb.num_rows == 0:
                continue
            kcols = [rb.column(k) for k in key_names]
            if not started:
                started = True
                pid = rb.column(_PID)[0].as_py()
                if pid in entering:
                    prev, carry = tuple(c[0].as_py() for c in kcols), tuple(entering[pid])
            ks = _key_change(kcols, prev)
            ts = rb.column("__tb_t").to_pylist()
            adm, left, carry = bucket_fold(ts, ks.tolist(), rps, carry if prev is not None else None)
            prev = tuple(c[-1].as_py() for c in kcols)
            out = rb.append_column("admitted", pa.array(adm, pa.bool_()))
            yield out.append_column("tokens_left", pa.array(left, pa.float64()))
    return fold


def _refold_bucket(ck: DataFrame, pid: int, rps: float, state: tuple) -> tuple:
    def run(it):
        carry, buf = state, []
        for r in it:  # one partition, streamed in slices
            buf.append(r["__tb_t"])
            if len(buf) >= 100_000:
                _, _, carry = bucket_fold(buf, [False] * len(buf), rps, carry)
                buf = []
        if buf:
            _, _, carry = bucket_fold(buf, [False] * len(buf), rps, carry)
        return [carry]
    return tuple(ck.sparkSession.sparkContext.runJob(ck.select("__tb_t").rdd, run, partitions=[pid])[0])


def throttle_range(requests: DataFrame, rps: float, tenant_col: str = "tenant_id", ts_col: str = "ts",
                   order: Sequence[str | Column] = (), num_partitions: int | None = None) -> DataFrame:
    """``throttle`` with a hot tenant spread over many tasks.

    Partition boundaries inside a tenant are resolved exactly on the driver from
    one summary row per partition: after a gap of one second or more the bucket
    is full whatever came before, so a partition with such a gap (or whose first
    request comes a second after the previous one) hands on a known state.
    Without one (sustained overload), the state depends on every earlier
    request: that partition is refolded alone from the true state, in order.
    """
    from pyspark import StorageLevel  # noqa: PLC0415

    from driftlog.session import ensure_checkpoint_dir, range_partitions  # noqa: PLC0415

    spark = requests.sparkSession
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    base = requests.columns
    x = requests.withColumn("__tb_t", F.unix_micros(F.col(ts_col).cast("timestamp")))
    sort_cols = [F.col(tenant_col), F.col("__tb_t"), *[F.col(o) if isinstance(o, str) else o for o in order]]
    n = range_partitions(requests, num_partitions)
    x = x.persist(StorageLevel.DISK_ONLY)
    ck = (x.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
          .withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True))
    x.unpersist()
    edges = sorted((r.asDict() for r in ck.select(_PID, tenant_col, "__tb_t")
                    .mapInArrow(_throttle_edges([tenant_col], float(rps)), THROTTLE_EDGES).collect()),
                   key=lambda r: r["pid"])
    entering, state, last_key = {}, None, None
    for e in edges:
        if state is not None and e["first_key"] == last_key:
            entering[e["pid"]] = state
            if not e["single"] or e["has_reset"] or e["t_first"] - state[1] >= 1_000_000:
                # the last key's state no longer depends on what came in
                state = ((e["exit_tokens"], e["exit_last"]) if not e["single"] or e["has_reset"]
                         else (e["fresh_tokens"], e["fresh_last"]))
            else:
                state = _refold_bucket(ck, e["pid"], float(rps), state)
        else:
            state = (e["exit_tokens"], e["exit_last"])
        last_key = e["last_key"]
    schema = T.StructType(list(ck.schema.fields) + [
        T.StructField("admitted", T.BooleanType(), False), T.StructField("tokens_left", T.DoubleType(), False)])
    y = ck.mapInArrow(_throttle_apply([tenant_col], float(rps), spark.sparkContext.broadcast(entering)), schema)
    return y.select(*base, "admitted", "tokens_left")
