"""Anchored windows for hot keys: a range-partitioned fold with exact boundary states.

A key may hold a large share of all rows (one tenant, one alert rule, one id
replayed many times). Hashing on the key would give it one task. Here:

1. ``repartitionByRange(keys, t, order)`` spreads a hot key over consecutive
   partitions. The sorted data is checkpointed (reliable, in the shared
   checkpoint folder), so both passes, and any later recomputation, read the
   very same partitions: a cache could be dropped and re-planned with newly
   sampled range bounds, which would no longer match the boundary states.
   This costs one write of the fold's input; it is why ``mode="auto"`` uses
   range mode only for inputs large enough for a key to outgrow a task.
2. Pass 1, in parallel: each partition reports a small summary. For a
   partition holding one key only, the window open at its end depends on the
   window carried in only through *how many leading rows that window still
   covers* (j). The last window for every j comes from pointer jumping over
   "next window start", compressed into runs of equal results, and is
   returned as a map over the carried window's end time.
3. The driver walks the partition summaries in order (one row per
   partition) and derives the exact carried-in window of each partition.
4. Pass 2, in parallel: every partition folds its rows from its true
   carried-in window.

A summary larger than ``MAX_RUNS`` (adversarial, lattice-like data) is not
sent; that partition is refolded alone from its true carried-in window
(one task), so the result is always exact.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlog.operators.anchored import MICROS, _key_change, fold_anchored
from driftlog.session import ensure_checkpoint_dir, range_partitions, ship_package

MAX_RUNS = 4096
_T, _W, _PID, _P = "__rf_t", "__rf_w", "__rf_pid", "__rf_pass"

SUMMARY = T.StructType([
    T.StructField("pid", T.IntegerType()),
    T.StructField("n", T.LongType()),
    T.StructField("first_key", T.StringType()),
    T.StructField("last_key", T.StringType()),
    T.StructField("single", T.BooleanType()),
    T.StructField("exit_a", T.LongType()), T.StructField("exit_e", T.LongType()), T.StructField("exit_c", T.LongType()),
    T.StructField("bounds", T.ArrayType(T.LongType())),
    T.StructField("run_a", T.ArrayType(T.LongType())),
    T.StructField("run_e", T.ArrayType(T.LongType())),
    T.StructField("run_c", T.ArrayType(T.LongType())),
    T.StructField("carry_through_from", T.LongType()),
    T.StructField("overflow", T.BooleanType()),
])


def _key_json(cols, i) -> str:
    return json.dumps([c[i].as_py() for c in cols], default=str)


def last_anchor_from_each_start(t: np.ndarray, w: np.ndarray, after: bool) -> np.ndarray:
    """For every row j, the index of the last window start reached when a window opens at j."""
    n = t.size
    side = "right" if after else "left"
    nxt = np.maximum(np.searchsorted(t, t + w, side=side), np.arange(1, n + 1))
    p = np.where(nxt < n, nxt, np.arange(n))
    while True:  # pointer doubling to the fixed point
        q = p[p]
        if np.array_equal(q, p):
            return p
        p = q


def head_map(t: np.ndarray, w: np.ndarray, after: bool, max_runs: int = MAX_RUNS, w_max: int | None = None):
    """Exit window as a function of the carried window's end E, for a one-key partition.

    Returns (bounds, run_a, run_e, run_c, carry_through_from, overflow): the run
    whose bound is the last one <= E (after) / < E (at_or_after) gives the exit;
    E at or past ``carry_through_from`` means the carried window covers every row.
    """
    n = t.size
    # rows any carried-in window can cover: it started at or before t[0] and is at most the
    # widest window of the whole input long
    wm = int(w.max()) if w_max is None else int(w_max)
    h = int(np.searchsorted(t, t[0] + wm, side="right"))
    L = last_anchor_from_each_start(t, w, after)
    js = np.arange(0, min(h, n - 1) + 1) if n else np.empty(0, dtype=np.int64)
    js = js[js < n]
    lj = L[js]
    change = np.ones(js.size, dtype=bool)
    change[1:] = lj[1:] != lj[:-1]
    starts = js[change]
    if starts.size > max_runs:
        return None, None, None, None, None, True
    # j >= s  <=>  E >= t[s-1] (after) / E > t[s-1] (at_or_after); s = 0 always applies
    bounds = np.where(starts > 0, t[np.maximum(starts - 1, 0)], np.iinfo(np.int64).min)
    la = L[starts]
    run_a = t[la]
    run_e = t[la] + w[la]
    run_c = n - la
    carry_from = int(t[n - 1]) if h >= n else None
    return bounds, run_a, run_e, run_c, carry_from, False


def _keyed(rb: pa.RecordBatch) -> pa.RecordBatch:
    keep = np.flatnonzero(~np.asarray(rb.column(_P).to_numpy(zero_copy_only=False), dtype=bool))
    return rb if keep.size == rb.num_rows else rb.take(pa.array(keep))


def _summarise(key_names, after, max_runs, w_max):
    def fold(batches):
        first_key = last_key = None
        t_first, w_first = [], []
        carry = None
        prev = None
        single = True
        n = 0
        pid = None
        for rb in batches:
            if rb.num_rows and pid is None:
                pid = rb.column(_PID)[0].as_py()
            rb = _keyed(rb)
            if rb.num_rows == 0:
                continue
            kcols = [rb.column(k) for k in key_names]
            ks = _key_change(kcols, prev)
            t = np.asarray(rb.column(_T).to_numpy(zero_copy_only=False), dtype=np.int64)
            w = np.asarray(rb.column(_W).to_numpy(zero_copy_only=False), dtype=np.int64)
            if first_key is None:
                first_key = _key_json(kcols, 0)
                ks[0] = True
            if single:
                cut = rb.num_rows if not ks[1:].any() else 1 + int(np.argmax(ks[1:]))
                if prev is not None and ks[0]:
                    cut = 0
                t_first.append(t[:cut])
                w_first.append(w[:cut])
                if cut < rb.num_rows:
                    single = False
            _, _, carry = fold_anchored(t, w, ks, after, carry if prev is not None else None)
            prev = tuple(c[-1].as_py() for c in kcols)
            last_key = _key_json(kcols, rb.num_rows - 1)
            n += rb.num_rows
        if n == 0:
            return
        row = {"pid": pid, "n": n, "first_key": first_key, "last_key": last_key, "single": single,
               "exit_a": carry[0], "exit_e": carry[1], "exit_c": carry[2], "bounds": None, "run_a": None,
               "run_e": None, "run_c": None, "carry_through_from": None, "overflow": False}
        if single:
            tt, ww = np.concatenate(t_first), np.concatenate(w_first)
            b, ra, re, rc, ctf, over = head_map(tt, ww, after, max_runs, w_max)
            row["overflow"] = over
            if not over:
                row.update(bounds=b.tolist(), run_a=ra.tolist(), run_e=re.tolist(), run_c=rc.tolist(),
                           carry_through_from=ctf)
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema([
            ("pid", pa.int32()), ("n", pa.int64()), ("first_key", pa.string()), ("last_key", pa.string()),
            ("single", pa.bool_()), ("exit_a", pa.int64()), ("exit_e", pa.int64()), ("exit_c", pa.int64()),
            ("bounds", pa.list_(pa.int64())), ("run_a", pa.list_(pa.int64())), ("run_e", pa.list_(pa.int64())),
            ("run_c", pa.list_(pa.int64())), ("carry_through_from", pa.int64()), ("overflow", pa.bool_())]))
    return fold


def _apply(key_names, after, entering_bc, out_names):
    def fold(batches):
        entering = entering_bc.value
        prev = None
        carry = None
        started = False
        for rb in batches:
            n = rb.num_rows
            if n == 0:
                continue
            t_all = np.asarray(rb.column(_T).to_numpy(zero_copy_only=False), dtype=np.int64)
            anchor, ordinal = t_all.copy(), np.ones(n, dtype=np.int64)
            keep = np.flatnonzero(~np.asarray(rb.column(_P).to_numpy(zero_copy_only=False), dtype=bool))
            sub = rb.take(pa.array(keep))
            if sub.num_rows:
                kcols = [sub.column(k) for k in key_names]
                if not started:
                    started = True
                    pid = rb.column(_PID)[0].as_py()
                    if pid in entering:
                        prev = tuple(c[0].as_py() for c in kcols)  # continue the key carried in
                        carry = tuple(entering[pid])
                ks = _key_change(kcols, prev)
                t = t_all[keep]
                w = np.asarray(sub.column(_W).to_numpy(zero_copy_only=False), dtype=np.int64)
                a, o, carry = fold_anchored(t, w, ks, after, carry if prev is not None else None)
                anchor[keep], ordinal[keep] = a, o
                prev = tuple(c[-1].as_py() for c in kcols)
            out = rb.append_column(out_names[0], pa.array(anchor, pa.int64()))
            yield out.append_column(out_names[1], pa.array(ordinal, pa.int64()))
    return fold


def _exit_given(s: dict, state: tuple, after: bool):
    """Exit window of a one-key partition for a carried-in window, from its summary."""
    a, e, c = state
    ctf = s["carry_through_from"]
    if ctf is not None and (e >= ctf if after else e > ctf):
        return (a, e, c + s["n"])
    b = np.asarray(s["bounds"], dtype=np.int64)
    r = int(np.searchsorted(b, e, side="right" if after else "left")) - 1
    r = max(r, 0)
    return (s["run_a"][r], s["run_e"][r], s["run_c"][r])


# Summaries are collected at once up to this many partitions; beyond, they are written to the
# checkpoint folder and read back in ranges of partition ids, so the driver holds one range.
SUMMARY_COLLECT_LIMIT = 2000
SUMMARY_CHUNK = 5000


def _ordered_summaries(summ: DataFrame, n_partitions: int):
    if n_partitions <= SUMMARY_COLLECT_LIMIT:
        yield from sorted((r.asDict() for r in summ.collect()), key=lambda r: r["pid"])
        return
    import uuid  # noqa: PLC0415

    spark = summ.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rangefold-summaries-{uuid.uuid4().hex}"
    summ.coalesce(max(1, n_partitions // 1000)).write.parquet(path)
    table = spark.read.parquet(path)
    for lo in range(0, n_partitions, SUMMARY_CHUNK):
        part = table.filter((F.col("pid") >= lo) & (F.col("pid") < lo + SUMMARY_CHUNK)).collect()
        yield from sorted((r.asDict() for r in part), key=lambda r: r["pid"])


def _refold_exit(ck: DataFrame, pid: int, key_names, after, state):
    """Exit window of one partition folded from a given carried-in window (fallback, one task)."""
    def run(it):
        carry = state
        t_buf, w_buf = [], []

        def flush(c):
            if not t_buf:
                return c
            t = np.array(t_buf, dtype=np.int64)
            w = np.array(w_buf, dtype=np.int64)
            t_buf.clear()
            w_buf.clear()
            return fold_anchored(t, w, np.zeros(t.size, dtype=bool), after, c)[2]

        for r in it:  # one partition, streamed in slices (one key throughout)
            if r[_P]:
                continue
            t_buf.append(r[_T])
            w_buf.append(r[_W])
            if len(t_buf) >= 100_000:
                carry = flush(carry)
        return [flush(carry)]
    sc = ck.sparkSession.sparkContext
    res = sc.runJob(ck.select(_T, _W, _P, *key_names).rdd, run, partitions=[pid])
    return tuple(res[0])


def entering_states(summaries, ck: DataFrame, key_names, after) -> dict:
    """Walk partition summaries in partition order (an ordered iterable); the carried-in window
    of every partition that continues a key."""
    entering = {}
    state, last_key = None, None
    for s in summaries:
        if state is not None and s["first_key"] == last_key:
            entering[s["pid"]] = state
            if s["single"]:
                state = (_exit_given(s, state, after) if not s["overflow"]
                         else _refold_exit(ck, s["pid"], key_names, after, state))
            else:
                state = (s["exit_a"], s["exit_e"], s["exit_c"])
        else:
            state = (s["exit_a"], s["exit_e"], s["exit_c"])
        last_key = s["last_key"]
    return entering


def anchored_windows_range(
    df: DataFrame, keys: Sequence[str], ts: str, width: int | float | str, boundary: str = "after",
    order: Sequence[str | Column] = (), passthrough: Column | None = None, anchor_col: str = "window_start",
    ordinal_col: str = "ordinal", num_partitions: int | None = None, max_runs: int = MAX_RUNS,
    width_max: float | None = None,
) -> DataFrame:
    """Same result as ``anchored_windows(mode="hash")``; hot keys spread over many tasks."""
    after = boundary == "after"
    spark = df.sparkSession
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    keys = list(keys)
    base = df.columns
    w_expr = ((F.col(width).cast("double") * MICROS).cast("long") if isinstance(width, str)
              else F.lit(int(round(float(width) * MICROS))).cast("long"))
    x = df.withColumn(_T, F.unix_micros(F.col(ts).cast("timestamp"))).withColumn(_W, w_expr)
    no_time = F.col(_T).isNull() | F.col(_W).isNull()
    pas = no_time if passthrough is None else (F.coalesce(passthrough, F.lit(False)) | no_time)
    x = x.withColumn(_P, pas).withColumn(_T, F.coalesce(F.col(_T), F.lit(0))).withColumn(
        _W, F.coalesce(F.col(_W), F.lit(0)))
    n = range_partitions(df, num_partitions)
    # passthrough rows sort first and spread by time; keyed rows follow in (key, time) order
    sort_cols = [F.col(_P).desc()] + [F.col(k) for k in keys] + [F.col(_T)] + [
        F.col(o) if isinstance(o, str) else o for o in order]
    # the range partitioner samples its input, then the shuffle reads it again: keep one copy
    # (disk, recomputable) so the upstream plan runs once
    x = x.persist(StorageLevel.DISK_ONLY)
    ck = (x.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
          .withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True))
    x.unpersist()
    # widest window anywhere: known for a constant width or from the caller, else one pass
    if not isinstance(width, str):
        w_max = int(round(float(width) * MICROS))
    elif width_max is not None:
        w_max = int(round(float(width_max) * MICROS))
    else:
        w_max = ck.agg(F.max(_W).alias("m")).first()["m"] or 0
    summ = ck.mapInArrow(_summarise(keys, after, max_runs, w_max), SUMMARY)
    entering = entering_states(_ordered_summaries(summ, n), ck, keys, after)
    entering_bc = spark.sparkContext.broadcast(entering)  # one row per partition at most
    schema = T.StructType(list(ck.schema.fields) + [T.StructField("__rf_a", T.LongType(), False),
                                                    T.StructField("__rf_o", T.LongType(), False)])
    y = ck.mapInArrow(_apply(keys, after, entering_bc, ("__rf_a", "__rf_o")), schema)
    anchor = F.when(F.col(ts).isNotNull(), F.timestamp_micros(F.col("__rf_a")))
    return y.select(*[F.col(c) for c in base], anchor.alias(anchor_col),
                    F.col("__rf_o").alias(ordinal_col))
