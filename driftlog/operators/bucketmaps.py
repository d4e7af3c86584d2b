"""Per-tenant token bucket in whole numbers, with one tenant spread over many tasks.

The same rule as ``throttle``: a bucket of ``rps`` tokens that starts full, refills elapsed x rps, and lets a
request in iff a token is left. Here tokens are counted in parts of 1 / (10^6 q) for rps = p / q, so a refill is
a whole number of parts and no rounding depends on the order of the requests before. (``throttle`` rounds as a
sequential double reference does; the two can differ where a bucket comes to exactly one token.)

What a run of requests does to the bucket is then a map from the parts before it to the parts after it, and maps
can be composed without knowing the state they start from. Two kinds of runs have closed forms:

* closer than one token's time (a <= U): x -> x - B while x >= B, else (x + S) mod U, with S the refills of the
  n requests, U the parts of a token and B = n U - S;
* further apart (a > U): x -> E + min(x, M), with E the gains and M the least room left under the cap.

A partition of the sorted requests is summed up as one piecewise map (pieces of slope 0 or 1; a tenant in
overload throughout has a handful), in parallel; the entering state of each partition follows from the maps
before it, one evaluation for each, and a second pass decides every request with the same closed forms in numpy.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlog.operators.anchored import _key_change
from driftlog.session import ensure_checkpoint_dir, range_partitions, ship_package

_T, _PID = "__bm_t", "__bm_pid"
#: Runs shorter than this are folded request by request.
SHORT = 16
SUMMARY = T.StructType([
    T.StructField("pid", T.IntegerType()), T.StructField("first_key", T.StringType()), T.StructField("last_key", T.StringType()),
    T.StructField("single", T.BooleanType()), T.StructField("t_first", T.LongType()), T.StructField("t_last", T.LongType()),
    T.StructField("lo", T.ArrayType(T.LongType())), T.StructField("val", T.ArrayType(T.LongType())),
    T.StructField("slope", T.ArrayType(T.LongType())),
])


class Bucket:
    """Sizes in parts: U of a token, C of the full bucket, ``gain`` of a number of microseconds."""

    def __init__(self, rps: float):
        r = Fraction(str(rps))
        self.rate, self.token, self.full = r.numerator, 1_000_000 * r.denominator, 1_000_000 * r.numerator

    def gain(self, micros: np.ndarray) -> np.ndarray:
        """Refills, cut to a full bucket."""
        return np.minimum(micros, 1_000_000) * self.rate

    def one(self, x: int, a: int) -> tuple[int, bool]:
        """One request after a refill of ``a``."""
        x = min(self.full, x + a)
        return (x - self.token, True) if x >= self.token else (x, False)

    def runs(self, a: np.ndarray):
        """(from, to, close): maximal runs of refills of at most a token, and of more."""
        close = a <= self.token
        edge = np.flatnonzero(np.diff(close)) + 1
        bounds = [0, *edge.tolist(), len(a)] if len(a) else [0]
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            yield lo, hi, bool(close[lo])

    def closed(self, n: int, close: bool) -> bool:
        """Has a run a closed form, and is it worth it? A bucket of under two tokens caps inside close runs."""
        return n >= SHORT and self.full >= (2 if close else 1) * self.token

    def fold(self, a: np.ndarray, x: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Admitted and parts left of requests with refills ``a``, from ``x`` parts; and the parts at the end."""
        u, c = self.token, self.full
        admitted, left = np.empty(len(a), bool), np.empty(len(a), np.int64)
        for lo, hi, close in self.runs(a):
            run = a[lo:hi]
            if not self.closed(hi - lo, close):
                for k, r in enumerate(run.tolist(), lo):
                    x, admitted[k] = self.one(x, r)
                    left[k] = x
                continue
            total = np.cumsum(run if close else run - u)
            if close:
                x = min(x, c - int(run[0]))
                burn = u * np.arange(1, len(run) + 1) - total  # what the run takes beyond its refills: never falls
                k = int(np.searchsorted(burn, x, "right"))  # the first request that finds no token
                admitted[lo : lo + k], left[lo : lo + k] = True, x - burn[:k]
                tokens, rest = np.divmod(x + total[k:], u)
                left[lo + k : hi] = rest
                admitted[lo + k : hi] = np.diff(tokens, prepend=k) > 0
            else:
                admitted[lo:hi] = True
                left[lo:hi] = total + np.minimum(x, np.minimum.accumulate(c - u - total))
            x = int(left[hi - 1])
        return admitted, left, x


class Map:
    """A map of [0, full] into itself: value val[i] + slope[i] * (x - lo[i]) from lo[i] up to the next lo."""

    def __init__(self, bucket: Bucket, lo=(0,), val=(0,), slope=(1,)):
        self.bucket = bucket
        self.lo, self.val, self.slope = (np.array(x, np.int64) for x in (lo, val, slope))

    def __call__(self, x: int) -> int:
        i = int(np.searchsorted(self.lo, x, "right")) - 1
        return int(self.val[i] + self.slope[i] * (x - self.lo[i]))

    def _last(self) -> np.ndarray:
        """The value at the end of every piece."""
        size = np.append(self.lo[1:], self.bucket.full + 1) - self.lo - 1
        return self.val + self.slope * size

    def _cut(self, points: np.ndarray) -> None:
        """New pieces begin at ``points``."""
        lo = np.union1d(self.lo, points)
        i = np.searchsorted(self.lo, lo, "right") - 1
        self.val, self.slope = self.val[i] + self.slope[i] * (lo - self.lo[i]), self.slope[i]
        self.lo = lo

    def _cut_at(self, value: int) -> None:
        """New pieces begin where a piece comes to ``value``."""
        hit = (self.slope == 1) & (self.val < value) & (value <= self._last())
        self._cut(self.lo[hit] + value - self.val[hit])

    def _set(self, where: np.ndarray, high, low) -> None:
        """Pieces ``where`` get the constant ``high``, the others the values ``low``."""
        self.val, self.slope = np.where(where, high, low), np.where(where, 0, self.slope)

    def _merge(self) -> None:
        """Neighbours on one line become one piece."""
        line = self.val - self.slope * self.lo
        keep = np.append(True, (np.diff(line) != 0) | (np.diff(self.slope) != 0))
        self.lo, self.val, self.slope = self.lo[keep], self.val[keep], self.slope[keep]

    def then(self, a: np.ndarray) -> None:
        """Follow this map by requests with refills ``a``."""
        b, u, c = self.bucket, self.bucket.token, self.bucket.full
        for lo, hi, close in b.runs(a):
            run = a[lo:hi]
            if c < (2 if close else 1) * u:
                for r in run.tolist():
                    self._cut_at(c - r)
                    self._set(self.val >= c - r, c, self.val + r)
                    self._cut_at(u)
                    self.val = np.where(self.val >= u, self.val - u, self.val)
                    self._merge()
                continue
            if close:
                first, total, n = int(run[0]), int(run.sum()), hi - lo
                burn = n * u - total
                self._cut_at(c - first)
                self._set(self.val >= c - first, c - first, self.val)
                self._cut_at(burn)
                # wraps: where x + total is a multiple of u, below burn
                last, points = self._last(), [np.empty(0, np.int64)]
                for i in np.flatnonzero((self.slope == 1) & (self.val < burn)):
                    wraps = np.arange(-(-(self.val[i] + total) // u) * u - total, last[i] + 1, u)
                    points.append(self.lo[i] + wraps - self.val[i])
                self._cut(np.concatenate(points))
                self.val = np.where(self.val >= burn, self.val - burn, (self.val + total) % u)
            else:
                gains = np.cumsum(run - u)
                room = int((c - u - gains).min())
                self._cut_at(room)
                self._set(self.val >= room, room + gains[-1], self.val + gains[-1])
            self._merge()


def _summaries(key_names: list[str], rps: float):
    def run(batches):
        bucket = Bucket(rps)
        prev = pid = first = last_key = t_first = last = None
        single, begun, x, now = True, False, 0, Map(bucket)
        for rb in batches:
            if not rb.num_rows:
                continue
            keys = [rb.column(k) for k in key_names]
            start = _key_change(keys, prev)
            t = np.asarray(rb.column(_T))
            prev = tuple(c[-1].as_py() for c in keys)
            if pid is None:
                pid, t_first = rb.column(_PID)[0].as_py(), int(t[0])
                first, start[0], last = json.dumps([c[0].as_py() for c in keys], default=str), False, t_first
            last_key = json.dumps(list(prev), default=str)
            gain = bucket.gain(np.diff(t, prepend=last))
            new = np.flatnonzero(start)
            if single:
                head = int(new[0]) if len(new) else len(t)
                now.then(gain[0 if begun else 1 : head])  # the refill of the first request depends on the partition before
                begun, single = True, head == len(t)
            if len(new):  # another key: its bucket starts full, whatever came before the partition
                gain[new] = bucket.full
                x = bucket.fold(gain[int(new[-1]) :], 0)[2]
            elif not single:
                x = bucket.fold(gain, x)[2]
            last = int(t[-1])
        if pid is None:
            return
        m = now if single else Map(bucket, (0,), (x,), (0,))
        yield pa.RecordBatch.from_arrays(
            [pa.array([pid], pa.int32()), pa.array([first]), pa.array([last_key]), pa.array([single]), pa.array([t_first]), pa.array([last]),
             *(pa.array([v.tolist()], pa.list_(pa.int64())) for v in (m.lo, m.val, m.slope))], SUMMARY.names)

    return run


def _decide(key_names: list[str], rps: float, held):
    def run(batches):
        bucket = Bucket(rps)
        prev, x, last = None, 0, None
        for rb in batches:
            if not rb.num_rows:
                continue
            keys = [rb.column(k) for k in key_names]
            start = _key_change(keys, prev)
            t = np.asarray(rb.column(_T))
            if prev is None:
                state = held.value.get(rb.column(_PID)[0].as_py())
                last = int(t[0])
                if state is not None:
                    (x, last), start[0] = state, False
            gain = bucket.gain(np.diff(t, prepend=last))
            gain[start] = bucket.full
            admitted, left, x = bucket.fold(gain, x)
            prev, last = tuple(c[-1].as_py() for c in keys), int(t[-1])
            yield rb.append_column("admitted", pa.array(admitted)).append_column("tokens_left", pa.array(left / bucket.token))

    return run


def throttle_exact(requests: DataFrame, rps: float, tenant_col: str = "tenant_id", ts_col: str = "ts",
                   order: Sequence[str | Column] = (), num_partitions: int | None = None) -> DataFrame:
    """Add ``admitted`` and ``tokens_left`` to each request; a request without a time is admitted, takes no
    token and has no ``tokens_left``."""
    spark = requests.sparkSession
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    base = requests.columns
    micros = F.unix_micros(F.col(ts_col).cast("timestamp"))
    untimed = requests.filter(micros.isNull()).withColumns({"admitted": F.lit(True), "tokens_left": F.lit(None).cast("double")})
    sort = [F.col(tenant_col), F.col(_T), *[F.col(o) if isinstance(o, str) else o for o in order]]
    rows = (requests.withColumn(_T, micros).filter(F.col(_T).isNotNull())
            .repartitionByRange(range_partitions(requests, num_partitions), *sort).sortWithinPartitions(*sort)
            .withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True))
    summed = rows.select(_PID, tenant_col, _T).mapInArrow(_summaries([tenant_col], rps), SUMMARY)
    bucket, entering, state, last, key = Bucket(rps), {}, None, None, None
    for s in sorted(summed.collect(), key=lambda r: r["pid"]):  # one row for each partition, one evaluation each
        x = bucket.full
        if s["first_key"] == key:
            entering[s["pid"]] = state, last
            x = bucket.one(state, int(bucket.gain(np.int64(s["t_first"] - last))))[0]
        else:
            x = bucket.one(0, bucket.full)[0]
        state = Map(bucket, s["lo"], s["val"], s["slope"])(x)
        key, last = s["last_key"], s["t_last"]
    schema = T.StructType([*rows.schema.fields, T.StructField("admitted", T.BooleanType(), False), T.StructField("tokens_left", T.DoubleType(), False)])
    out = rows.mapInArrow(_decide([tenant_col], rps, spark.sparkContext.broadcast(entering)), schema)
    return out.select(*base, "admitted", "tokens_left").unionByName(untimed)
