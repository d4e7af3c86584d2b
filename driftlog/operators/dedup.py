"""Drop repeats of a log id seen within a TTL (first sight wins, TTL not extended)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.operators.anchored import anchored_windows
from driftlog.session import fold_mode

# Repeated ids are broadcast (to route only their rows through the fold) up to this many.
MAX_BROADCAST_REPEATED_IDS = 2_000_000


def dedup_ttl(
    entries: DataFrame,
    ttl_seconds: float = 300,
    keys: Sequence[str] = ("log_id",),
    arrival: str = "ingest_timestamp",
    order: Sequence[str] = ("log_id",),
    num_partitions: int | None = None,
    mode: str = "auto",
    prefilter: bool | None = None,
) -> DataFrame:
    """Keep the first entry per id and TTL window; an entry at exactly first-sight + TTL is new.

    Ids are global across tenants by default (``keys=["tenant_id", "log_id"]`` scopes them).
    Entries with an empty id are never deduplicated: they pass through the same
    shuffle spread by content, so an empty id cannot become one hot group.
    On large inputs (``mode="auto"``) the fold runs in range mode, so an id with
    very many copies is spread over many tasks (exact), see ``rangefold``.

    ``prefilter`` (default: on for large inputs): an id seen once is always kept,
    so first find the repeated ids (a partial count over the id columns only);
    if they pass a size check they are broadcast, rows of all other ids pass
    through without any shuffle, and only the repeated ids' rows are folded.
    """
    keys = list(keys)
    resolved = fold_mode(entries, mode)
    if prefilter is None:
        prefilter = resolved == "range"
    empty = F.coalesce(F.col("log_id"), F.lit(""), ) == ""
    if prefilter:
        out = _dedup_repeated_only(entries, ttl_seconds, keys, arrival, list(order), num_partitions, resolved)
        if out is not None:
            return out
    marked = anchored_windows(
        entries, keys, arrival, ttl_seconds, boundary="at_or_after", order=list(order),
        passthrough=empty, anchor_col="__dd_anchor", ordinal_col="__dd_ord",
        num_partitions=num_partitions, mode=resolved,
    )
    return marked.filter(F.col("__dd_ord") == 1).drop("__dd_anchor", "__dd_ord")


def _dedup_repeated_only(entries, ttl_seconds, keys, arrival, order, num_partitions, mode):
    foldable = (F.coalesce(F.col("log_id"), F.lit("")) != "") & F.col(arrival).isNotNull()
    repeated = (entries.filter(foldable).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
                .filter(F.col("__n") > 1).select(*keys))
    n = repeated.count()
    if n > MAX_BROADCAST_REPEATED_IDS:
        return None  # too many to broadcast: fold everything
    # null-safe: a key column may be null, and nulls are one key in the fold
    named = repeated.select(*[F.col(k).alias(f"__rep_{i}") for i, k in enumerate(keys)], F.lit(True).alias("__rep"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__rep_{i}")) for i, k in enumerate(keys)])
    tagged = entries.join(F.broadcast(named), same, "left")
    tagged = tagged.withColumn("__rep", F.coalesce(F.col("__rep"), F.lit(False)) & foldable).select(*entries.columns, "__rep")
    single = tagged.filter(~F.col("__rep")).drop("__rep")
    multi = tagged.filter(F.col("__rep")).drop("__rep")
    marked = anchored_windows(multi, keys, arrival, ttl_seconds, boundary="at_or_after", order=order,
                              anchor_col="__dd_anchor", ordinal_col="__dd_ord", num_partitions=num_partitions,
                              mode=mode)
    kept = marked.filter(F.col("__dd_ord") == 1).drop("__dd_anchor", "__dd_ord")
    return single.unionByName(kept)
