"""Streaming dedup and alert windows: keyed state with ``applyInPandasWithState``.

The per-key step is the same anchored fold as the batch operator
(``fold_anchored``); the state is the open window (start, end, count), and
windows are measured on the arrival column. Each call sees one key's rows of one
micro-batch, which the trigger bounds (maxFilesPerTrigger / maxOffsetsPerTrigger).

Alert windows have few keys: a state for each. Dedup has a key for each id, and a call for a key costs some
milliseconds whatever it does, so its keys lie in BUCKETS by their hash: a call folds all keys of a bucket at once,
and the bucket's state holds their windows, with the time at which each is dropped.

By default no row is ever late: the watermark is on the time of the micro-batch that
reads a row, a row that comes after newer ones is folded into its key's open window,
and a key's state is dropped ``retention_seconds`` of wall clock after its last row (at
least the window's length). With ``watermark`` state follows event time instead, and
Spark drops rows behind the watermark; only for sources that promise no later rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from driftlog.operators.alerts import match_rules
from driftlog.operators.anchored import MICROS, fold_anchored
from driftlog.session import ship_package

STATE_SCHEMA = "anchor long, end long, count long"
_T = "__st_t"
_W = "__st_w"
_P = "__st_pass"
_K = "__st_key"
_READ = "__st_read"
_ROW = "__st_row"
_B = "__st_bucket"
_PACKED = (T.StringType, T.TimestampType, T.LongType, T.IntegerType, T.BooleanType)


#: Wall-clock time that a key's state outlives its last row by, at least.
RETENTION_SECONDS = 3600


#: Groups of a dedup stream's keys. Its checkpoints are laid out by it: a change needs a new checkpoint.
BUCKETS = 512
BUCKET_STATE = "windows binary"
_WINDOWS = pa.schema([("key", pa.string()), *[(c, pa.int64()) for c in ("anchor", "end", "count", "due")]])


def _clocked(x: DataFrame, arrival: str, watermark: str | None) -> DataFrame:
    """The stream with its state clock: event time, or the time of the micro-batch (which no row is behind)."""
    if watermark is not None:
        return x.withColumn(_READ, F.col(arrival)).withWatermark(_READ, watermark)
    return x.withColumn(_READ, F.current_timestamp()).withWatermark(_READ, "0 seconds")


def _handler(order: Sequence[str], after: bool, emit, watermark: str | None = None, retention_seconds: float = RETENTION_SECONDS):
    order = list(order)

    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        frames = [p for p in pdfs if len(p)]
        if not frames:
            return
        if len(frames) == 1 and len(frames[0]) == 1:  # most keys: nothing to sort
            pdf = frames[0]
        else:
            pdf = pd.concat(frames, ignore_index=True).sort_values([_T, *order], kind="stable")
        t = pdf[_T].to_numpy(dtype=np.int64)
        w = pdf[_W].to_numpy(dtype=np.int64)
        carry = tuple(int(v) for v in state.get) if state.exists else None
        ks = np.zeros(len(t), dtype=bool)
        ks[0] = carry is None
        anchor, ordinal, new = fold_anchored(t, w, ks, after, carry)
        state.update(new)
        if watermark is None:
            length_ms = int(w.max()) // 1000 + 1
            now_ms = max(state.getCurrentProcessingTimeMs(), state.getCurrentWatermarkMs() + 1)
            state.setTimeoutTimestamp(now_ms + max(length_ms, int(retention_seconds * 1000)))
        else:  # drop the state once event time passes the window end
            end_ms = new[1] // 1000 + 1
            state.setTimeoutTimestamp(max(end_ms, state.getCurrentWatermarkMs() + 1))
        out = emit(pdf, anchor, ordinal)
        if len(out):
            yield out
    return fn


def _fold_bucket(code: np.ndarray, t: np.ndarray, w: np.ndarray, windows: tuple[np.ndarray, np.ndarray, np.ndarray],
                 held: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Which rows open a window, and the keys' windows after them.

    Rows are sorted by (key's number, time). ``windows``: (anchor, end, count) by number, of the keys that ``held`` names.
    """
    anchor, end, count = (x.copy() for x in windows)
    inside = held[code] & (t < end[code])  # a key's first rows: those in the window that it came with
    count += np.bincount(code[inside], minlength=len(count))
    rest = np.flatnonzero(~inside)
    first = np.zeros(len(t), bool)
    if len(rest):
        c, t, w = code[rest], t[rest], w[rest]
        new = np.concatenate(([True], c[1:] != c[:-1]))
        at, ordinal, _ = fold_anchored(t, w, new, False, None)
        first[rest] = ordinal == 1
        last = np.flatnonzero(np.concatenate((c[1:] != c[:-1], [True])))
        anchor[c[last]], count[c[last]] = at[last], ordinal[last]
        end[c[last]] = at[last] + w[last - ordinal[last] + 1]
    return first, (anchor, end, count)


def _read_windows(blob: bytes) -> pa.Table:
    with pa.ipc.open_stream(blob) as r:
        return r.read_all()


def _write_windows(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _WINDOWS) as w:
        w.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _bucket_handler(order: Sequence[str], columns: Sequence[str], watermark: str | None = None, retention_seconds: float = RETENTION_SECONDS):
    """The fold of all of a bucket's keys: emits ``columns`` of each row that opens a window, and of rows to pass."""
    order, columns = list(order), list(columns)

    def fn(key, pdfs, state):
        held = _read_windows(state.get[0]) if state.exists else _WINDOWS.empty_table()
        now_ms = state.getCurrentWatermarkMs()
        frames = [] if state.hasTimedOut else [p for p in pdfs if len(p)]
        out = [p.loc[p[_P], columns] for p in frames]  # rows without an id or time: emitted as they are, no state
        frames = [p[~p[_P]] for p in frames if not p[_P].all()]
        stays = np.asarray(held["due"]) >= now_ms
        touched = _WINDOWS.empty_table()
        if frames:
            pdf = frames[0].reset_index(drop=True) if len(frames) == 1 else pd.concat(frames, ignore_index=True)
            code, keys = pd.factorize(pdf[_K])
            rank = pdf[[_T, *order]].assign(**{_K: code}).sort_values([_K, _T, *order], kind="stable").index.to_numpy()
            code, keys = code[rank], pa.array(keys, pa.string())
            t, w = (pdf[c].to_numpy(dtype=np.int64)[rank] for c in (_T, _W))
            place = pc.index_in(keys, value_set=held["key"].combine_chunks())
            known, at = np.asarray(place.is_valid()), np.asarray(place.fill_null(0))
            windows = [np.where(known, np.asarray(held[c])[at], 0) if len(held) else np.zeros(len(keys), np.int64) for c in ("anchor", "end", "count")]
            first, (anchor, end, count) = _fold_bucket(code, t, w, tuple(windows), known)
            if watermark is None:
                length_ms = int(w.max()) // 1000 + 1
                due = max(state.getCurrentProcessingTimeMs(), now_ms + 1) + max(length_ms, int(retention_seconds * 1000))
                due = np.full(len(keys), due, np.int64)
            else:  # a key goes once event time passes its window's end
                due = np.maximum(end // 1000 + 1, now_ms + 1)
            touched = pa.table([keys, *[pa.array(x, pa.int64()) for x in (anchor, end, count, due)]], schema=_WINDOWS)
            stays[at[known]] = False
            out.append(pdf.loc[np.sort(rank[first]), columns])
        held = pa.concat_tables([held.filter(pa.array(stays)), touched])
        if len(held):
            state.update((_write_windows(held),))
            state.setTimeoutTimestamp(max(pc.min(held["due"]).as_py(), now_ms + 1))
        elif state.exists:
            state.remove()
        yield from (x for x in out if len(x))
    return fn


def dedup_stream(entries: DataFrame, ttl_seconds: float = 300, keys: Sequence[str] = ("log_id",),
                 arrival: str = "ingest_timestamp", order: Sequence[str] = ("log_id",),
                 watermark: str | None = None, passthrough: Column | None = None,
                 retention_seconds: float = RETENTION_SECONDS) -> DataFrame:
    """Streaming ``dedup_ttl``: first sight per id wins for ``ttl_seconds`` of arrival time.

    Every row goes through one stateful operator (so the source is read once):
    entries key on their id; rows with an empty id, no arrival time or a true
    ``passthrough`` go to a bucket by their content and are emitted as they are,
    without touching the state.
    """
    ship_package(entries.sparkSession)
    keys = list(keys)
    columns, has_fields = entries.columns, "fields" in entries.columns
    x = entries.withColumn("fields", F.to_json("fields")) if has_fields else entries
    pas = (F.coalesce(F.col("log_id"), F.lit("")) == "") | F.col(arrival).isNull()
    if passthrough is not None:
        pas = pas | F.coalesce(passthrough, F.lit(False))
    key = F.when(~pas, F.to_json(F.struct(*[F.col(k) for k in keys])))
    keyed = (_clocked(x.withColumn(_P, pas).withColumn(_K, key), arrival, watermark)
             .withColumn(_T, F.coalesce(F.unix_micros(F.col(arrival)), F.lit(0)))
             .withColumn(_W, F.lit(int(ttl_seconds * MICROS))))
    # what the fold does not read goes through it as one text
    packed = [f for f in x.schema.fields if f.name not in order and isinstance(f.dataType, _PACKED)]
    times = {f.name for f in packed if isinstance(f.dataType, T.TimestampType)}
    pack = F.to_json(F.struct(*[F.unix_micros(f.name).alias(f.name) if f.name in times else F.col(f.name) for f in packed]))
    keyed = keyed.withColumn(_ROW, pack).drop(*[f.name for f in packed])
    keyed = keyed.withColumn(_B, F.pmod(F.xxhash64(F.coalesce(_K, _ROW)), F.lit(BUCKETS)).cast("int"))
    schema = T.StructType([f for f in keyed.schema.fields if f.name not in (_READ, _P, _K, _T, _W, _B)])
    kept = keyed.groupBy(_B).applyInPandasWithState(
        _bucket_handler(order, schema.names, watermark=watermark, retention_seconds=retention_seconds),
        schema, BUCKET_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    unpacked = T.StructType([T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in packed])
    out = kept.withColumn(_ROW, F.from_json(_ROW, unpacked, {"maxStringLen": str((1 << 31) - 1)}))
    held = {f.name: F.col(f"{_ROW}.{f.name}") for f in packed}
    held = {c: F.timestamp_micros(v) if c in times else v for c, v in held.items()}
    out = out.select(*[held.get(c, F.col(c)).alias(c) for c in columns])
    if has_fields:
        out = out.withColumn("fields", F.from_json("fields", T.MapType(T.StringType(), T.StringType())))
    return out


def alerts_stream(entries: DataFrame, rules: DataFrame, arrival: str = "ingest_timestamp",
                  order: Sequence[str] = ("log_id",), watermark: str | None = None,
                  retention_seconds: float = RETENTION_SECONDS) -> DataFrame:
    """Streaming ``evaluate_rules``: rules join the stream (broadcast, static side), the window
    state per (rule, tenant) lives in the state store, and every match with count >= threshold
    is emitted."""
    ship_package(entries.sparkSession)
    x = entries.drop("fields") if "fields" in entries.columns else entries
    x = x.filter(F.col(arrival).isNotNull())
    m = match_rules(_clocked(x, arrival, watermark), rules)
    m = m.withColumn(_T, F.unix_micros(F.col(arrival))).withColumn(_W, F.col("rule_window_s") * MICROS)
    cols = ["rule", "tenant_id", "service", "message", "log_id", arrival, "rule_threshold", "rule_webhook",
            "rule_pos", _T, _W, _READ] + [o for o in order if o not in ("log_id",)]
    m = m.select(*dict.fromkeys(cols))
    out_schema = T.StructType([
        T.StructField("rule", T.StringType()), T.StructField("tenant_id", T.StringType()),
        T.StructField("service", T.StringType()), T.StructField("count", T.LongType()),
        T.StructField("fired_at", T.TimestampType()), T.StructField("sample_message", T.StringType()),
        T.StructField("webhook", T.StringType()), T.StructField("log_id", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
    ])

    def emit(pdf, anchor, ordinal):
        fire = ordinal >= pdf["rule_threshold"].to_numpy()
        sel = pdf[fire]
        return pd.DataFrame({
            "rule": sel["rule"], "tenant_id": sel["tenant_id"], "service": sel["service"],
            "count": ordinal[fire].astype("int64"), "fired_at": sel[arrival],
            "sample_message": sel["message"], "webhook": sel["rule_webhook"], "log_id": sel["log_id"],
            "window_start": pd.to_datetime(anchor[fire], unit="us", utc=True),
        })

    return m.groupBy("rule", "tenant_id").applyInPandasWithState(
        _handler(list(order) + ["rule_pos"], True, emit, watermark=watermark, retention_seconds=retention_seconds),
        out_schema, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
