"""Anchored windows: per key, a window opens at the first event and lasts W.

The next event past the window end opens a new one. These are not epoch-aligned
tumbling windows, so ``F.window`` cannot express them; the fold below does.

Plan: one hash shuffle on the key, a sort inside each partition, then a
``mapInArrow`` fold. The fold carries (key, anchor, end, count) across Arrow
batches, so memory stays constant and no group is ever materialised. Inside a
batch it jumps anchor -> anchor with ``numpy.searchsorted`` instead of looping
over rows. Keys are cut at every forced break (a gap that no window can
bridge) and all segments hop at once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlog.session import fold_mode, ship_package

MICROS = 1_000_000
_T = "__aw_t"
_W = "__aw_w"
_P = "__aw_pass"
_PART = "__aw_part"


def _key_change(cols: list[pa.ChunkedArray | pa.Array], prev_key: tuple | None) -> np.ndarray:
    """Boolean per row: the key differs from the row before (row 0 compares with the carried key)."""
    n = len(cols[0]) if cols else 0
    out = np.zeros(n, dtype=bool)
    if n == 0:
        return out
    for c in cols:
        if n > 1:
            ne = pc.fill_null(pc.not_equal(c[1:], c[:-1]), True)
            # two NULLs count as equal keys
            both_null = pc.and_(pc.is_null(c[1:]), pc.is_null(c[:-1]))
            ne = pc.and_(ne, pc.invert(both_null))
            out[1:] |= np.asarray(ne.to_numpy(zero_copy_only=False), dtype=bool)
    if prev_key is None:
        out[0] = True
    else:
        first = tuple(c[0].as_py() for c in cols)
        out[0] = first != prev_key
    return out


_Z_LIMIT = 1 << 62


def fold_anchored(t: np.ndarray, w: np.ndarray, key_start: np.ndarray, after: bool,
                  carry: tuple | None) -> tuple[np.ndarray, np.ndarray, tuple | None]:
    """Anchor time and ordinal for sorted rows, in slices small enough for the position layout."""
    n = t.size
    if n == 0:
        return _fold_slice(t, w, key_start, after, carry)
    step = max(1, _Z_LIMIT // (int(w.max()) + 2))
    if n <= step:
        return _fold_slice(t, w, key_start, after, carry)
    anchor = np.empty(n, dtype=np.int64)
    ordinal = np.empty(n, dtype=np.int64)
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        anchor[lo:hi], ordinal[lo:hi], carry = _fold_slice(t[lo:hi], w[lo:hi], key_start[lo:hi], after,
                                                           carry if lo == 0 or not key_start[lo] else None)
    return anchor, ordinal, carry


def _fold_slice(t: np.ndarray, w: np.ndarray, key_start: np.ndarray, after: bool,
                carry: tuple | None) -> tuple[np.ndarray, np.ndarray, tuple | None]:
    """Anchor time and ordinal for sorted rows.

    t: int64 micros, w: int64 micros (width of a window opened at that row),
    key_start: True where a new key begins, carry: (anchor_t, end, count) of the
    window still open for the first key, or None.
    Returns (anchor_t, ordinal, carry for the last key).
    """
    n = t.size
    anchor_t = np.empty(n, dtype=np.int64)
    ordinal = np.empty(n, dtype=np.int64)
    if n == 0:
        return anchor_t, ordinal, carry

    # rows of the first key that still fall in the carried window
    pre = 0
    if carry is not None and not key_start[0]:
        c_anchor, c_end, c_count = carry
        first_key_len = n if not key_start[1:].any() else 1 + int(np.argmax(key_start[1:]))
        seg = t[:first_key_len]
        pre = int(np.searchsorted(seg, c_end, side="right" if after else "left"))
        anchor_t[:pre] = c_anchor
        ordinal[:pre] = c_count + np.arange(1, pre + 1)
    if pre == n:
        return anchor_t, ordinal, (carry[0], carry[1], carry[2] + pre)

    tt = t[pre:]
    ww = w[pre:]
    m = tt.size
    max_w = int(ww.max())
    gap = np.empty(m, dtype=np.int64)
    gap[0] = 0
    gap[1:] = tt[1:] - tt[:-1]
    start = key_start[pre:].copy()
    start[0] = True
    # a gap no window can bridge always opens a new window
    start[1:] |= (gap[1:] > max_w) if after else (gap[1:] >= max_w)

    # lay segments end to end, each separated by more than any width
    step = np.where(start, max_w + 1, gap)
    step[0] = 0
    z = np.cumsum(step)
    is_anchor = start.copy()
    side = "right" if after else "left"
    cur = np.flatnonzero(start[:-1] & ~start[1:]) if m > 1 else np.empty(0, dtype=np.int64)
    # only segments with more than one row need hops
    while cur.size:
        nxt = np.searchsorted(z, z[cur] + ww[cur], side=side)
        nxt = np.maximum(nxt, cur + 1)
        nxt = nxt[nxt < m]
        nxt = nxt[~is_anchor[nxt]]
        is_anchor[nxt] = True
        cur = nxt

    idx = np.arange(m)
    a_idx = np.maximum.accumulate(np.where(is_anchor, idx, 0))
    anchor_t[pre:] = tt[a_idx]
    ordinal[pre:] = idx - a_idx + 1
    last_a = int(a_idx[-1])
    new_carry = (int(tt[last_a]), int(tt[last_a] + ww[last_a]), int(m - last_a))
    return anchor_t, ordinal, new_carry


def _make_fold(key_names: list[str], after: bool, has_pass: bool, out_names: tuple[str, str]):
    def fold(batches):
        prev_key = None
        carry = None
        for rb in batches:
            n = rb.num_rows
            if n == 0:
                continue
            t_all = np.asarray(pc.fill_null(rb.column(_T), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            w_all = np.asarray(pc.fill_null(rb.column(_W), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            anchor = t_all.copy()
            ordinal = np.ones(n, dtype=np.int64)
            if has_pass:
                pas = np.asarray(rb.column(_P).to_numpy(zero_copy_only=False), dtype=bool)
                keep = np.flatnonzero(~pas)
            else:
                keep = None
            sub = rb if keep is None else rb.take(pa.array(keep))
            if sub.num_rows:
                kcols = [sub.column(k) for k in key_names]
                ks = _key_change(kcols, prev_key)
                t = t_all if keep is None else t_all[keep]
                w = w_all if keep is None else w_all[keep]
                a, o, carry = fold_anchored(t, w, ks, after, carry if prev_key is not None else None)
                if keep is None:
                    anchor, ordinal = a, o
                else:
                    anchor[keep] = a
                    ordinal[keep] = o
                prev_key = tuple(c[-1].as_py() for c in kcols)
            out = rb.append_column(out_names[0], pa.array(anchor, pa.int64()))
            out = out.append_column(out_names[1], pa.array(ordinal, pa.int64()))
            yield out
    return fold


def anchored_windows(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    width: int | float | str,
    boundary: str = "after",
    order: Sequence[str | Column] = (),
    passthrough: Column | None = None,
    anchor_col: str = "window_start",
    ordinal_col: str = "ordinal",
    num_partitions: int | None = None,
    mode: str = "auto",
    width_max: float | None = None,
) -> DataFrame:
    """Add ``window_start`` (timestamp of the window's first event) and ``ordinal`` (1-based
    position in the window) to every row.

    mode: "hash" (one shuffle on the key; a key is one streaming task), "range"
    (``rangefold``: a hot key is spread over many tasks, exact via boundary
    states) or "auto" (range when the input is estimated above
    ``spark.driftlog.rangeFoldMinBytes``, where one key could outgrow a task).

    keys: grouping columns; ts: event-time column (timestamp); width: seconds, or
    the name of a column giving the width of a window opened at that row;
    boundary: "after" (new window iff t > start + W, alerts) or "at_or_after"
    (new iff t >= start + W, TTL expiry); order: tie-break columns after ts;
    passthrough: rows where it is true are never grouped (ordinal 1, no state);
    width_max: an upper bound of a width column (saves a pass in range mode).
    """
    if boundary not in ("after", "at_or_after"):
        raise ValueError("boundary must be 'after' or 'at_or_after'")
    mode = fold_mode(df, mode)
    if mode == "range":
        from driftlog.operators.rangefold import anchored_windows_range  # noqa: PLC0415

        return anchored_windows_range(df, keys, ts, width, boundary, order, passthrough, anchor_col,
                                      ordinal_col, num_partitions, width_max=width_max)
    if mode != "hash":
        raise ValueError("mode must be 'hash' or 'range'")
    after = boundary == "after"
    ship_package(df.sparkSession)
    keys = list(keys)
    base_cols = df.columns
    if isinstance(width, str):
        w_expr = (F.col(width).cast("double") * MICROS).cast("long")
    else:
        w_expr = F.lit(int(round(float(width) * MICROS))).cast("long")
    x = df.withColumn(_T, F.unix_micros(F.col(ts).cast("timestamp"))).withColumn(_W, w_expr)
    # rows without a time cannot be placed in a window: they pass through (ordinal 1)
    no_time = F.col(_T).isNull() | F.col(_W).isNull()
    passthrough = no_time if passthrough is None else (F.coalesce(passthrough, F.lit(False)) | no_time)
    has_pass = True
    if has_pass:
        x = x.withColumn(_P, F.coalesce(passthrough, F.lit(False)))
        # passthrough rows spread by content; keyed rows co-locate by key
        hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
        part = F.when(F.col(_P), F.xxhash64(*[F.col(c) for c in hashable])).otherwise(
            F.xxhash64(*[F.col(k) for k in keys]))
        x = x.withColumn(_PART, part)
        part_cols = [F.col(_PART)]
    else:
        part_cols = [F.col(k) for k in keys]
    x = x.repartition(num_partitions, *part_cols) if num_partitions else x.repartition(*part_cols)
    sort_cols = ([F.col(_P)] if has_pass else []) + [F.col(k) for k in keys] + [F.col(_T)] + [
        F.col(o) if isinstance(o, str) else o for o in order]
    x = x.sortWithinPartitions(*sort_cols)
    out_schema = T.StructType(list(x.schema.fields) + [
        T.StructField("__aw_anchor", T.LongType(), False),
        T.StructField("__aw_ord", T.LongType(), False),
    ])
    y = x.mapInArrow(_make_fold(keys, after, has_pass, ("__aw_anchor", "__aw_ord")), out_schema)
    return y.select(
        *[F.col(c) for c in base_cols],
        F.when(F.col(_T).isNotNull(), F.timestamp_micros(F.col("__aw_anchor"))).alias(anchor_col),
        F.col("__aw_ord").alias(ordinal_col),
    )
