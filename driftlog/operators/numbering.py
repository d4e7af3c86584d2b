"""Exact consecutive row numbers per key without putting a key in one task.

Plan: range-partition on (key, order) so a hot key spreads over consecutive
partitions (the sorted data is checkpointed), count the first and last key of
every partition in a pass that reads only the key columns, chain those
counts on the driver (one small row per partition; only a key that crosses a
partition boundary gets an offset), then number rows locally in one pass with
the offsets added. No join and no key-sized group anywhere.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlog.operators.anchored import _key_change
from driftlog.session import ensure_checkpoint_dir, fold_mode, range_partitions, ship_package

_PID = "__nw_pid"

EDGES = T.StructType([
    T.StructField("pid", T.IntegerType()), T.StructField("first_key", T.StringType()),
    T.StructField("last_key", T.StringType()), T.StructField("first_n", T.LongType()),
    T.StructField("last_n", T.LongType()), T.StructField("single", T.BooleanType()),
])


def _key_json(cols, i):
    return json.dumps([c[i].as_py() for c in cols], default=str)


def _edges(key_names):
    def fold(batches):
        pid = first = last = None
        first_n = last_n = 0
        single = True
        prev = None
        for rb in batches:
            n = rb.num_rows
            if n == 0:
                continue
            if pid is None:
                pid = rb.column(_PID)[0].as_py()
            kcols = [rb.column(k) for k in key_names]
            kc = _key_change(kcols, prev)
            if first is None:
                first, kc[0] = _key_json(kcols, 0), True
            starts = np.flatnonzero(kc)
            if single:
                if prev is not None and kc[0]:
                    single = False
                else:
                    head = n if starts.size <= 1 and (starts.size == 0 or starts[0] == 0) else int(
                        starts[1] if starts[0] == 0 else starts[0])
                    first_n += head
                    if head < n:
                        single = False
            last_start = int(starts[-1]) if starts.size else 0
            last_n = (last_n if (starts.size == 0) else 0) + (n - last_start)
            prev = tuple(c[n - 1].as_py() for c in kcols)
            last = _key_json(kcols, n - 1)
        if pid is not None:
            yield pa.RecordBatch.from_pylist(
                [{"pid": pid, "first_key": first, "last_key": last, "first_n": first_n, "last_n": last_n,
                  "single": single}],
                schema=pa.schema([("pid", pa.int32()), ("first_key", pa.string()), ("last_key", pa.string()),
                                  ("first_n", pa.int64()), ("last_n", pa.int64()), ("single", pa.bool_())]))
    return fold


def _number(key_names, out, offsets_bc):
    def fold(batches):
        offsets = offsets_bc.value
        prev = None
        count = 0
        for rb in batches:
            n = rb.num_rows
            if n == 0:
                continue
            kcols = [rb.column(k) for k in key_names]
            if prev is None:
                pid = rb.column(_PID)[0].as_py()
                if pid in offsets:  # the first key continues from earlier partitions
                    prev, count = tuple(c[0].as_py() for c in kcols), offsets[pid]
            kc = _key_change(kcols, prev)
            idx = np.arange(n, dtype=np.int64)
            start_idx = np.maximum.accumulate(np.where(kc, idx, -1))
            local = idx - start_idx + 1
            head = start_idx < 0
            local[head] = count + idx[head] + 1
            count = int(local[-1])
            prev = tuple(c[n - 1].as_py() for c in kcols)
            yield rb.append_column(out, pa.array(local, pa.int64()))
    return fold


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "row_no",
                  num_partitions: int | None = None, mode: str = "auto") -> DataFrame:
    """Add ``out`` = 1-based position of each row within its key under ``order``.

    mode "range" is the distributed plan above; "hash" is a ``row_number`` window (one
    task per key, fine while no key outgrows a task); "auto" picks range for inputs
    estimated at or above ``spark.driftlog.rangeFoldMinBytes``.
    """
    if fold_mode(df, mode) == "hash":
        w = Window.partitionBy(*keys).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order])
        return df.withColumn(out, F.row_number().over(w).cast("long"))
    spark = df.sparkSession
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    keys = list(keys)
    sort_cols = [F.col(k) for k in keys] + [F.col(o) if isinstance(o, str) else o for o in order]
    n = range_partitions(df, num_partitions)
    x = df.persist(StorageLevel.DISK_ONLY)  # sampled by the range partitioner, then shuffled: compute once
    ck = (x.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
          .withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True))
    x.unpersist()
    edges = sorted((r.asDict() for r in ck.select(_PID, *keys).mapInArrow(_edges(keys), EDGES).collect()),
                   key=lambda r: r["pid"])
    offsets, run_key, run_n = {}, None, 0
    for e in edges:
        if e["first_key"] == run_key:
            offsets[e["pid"]] = run_n
            run_n = run_n + e["first_n"] if e["single"] else e["last_n"]
        else:
            run_n = e["last_n"] if not e["single"] else e["first_n"]
        run_key = e["last_key"]
    schema = T.StructType(list(ck.schema.fields) + [T.StructField(out, T.LongType(), False)])
    return ck.mapInArrow(_number(keys, out, spark.sparkContext.broadcast(offsets)), schema).drop(_PID)
