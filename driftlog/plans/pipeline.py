"""Batch pipeline: raw batch messages -> normalized bus rows, hot table, cold archive, dead letters.

Order of steps is semantic: validation precedes dedup (a rejected entry never
claims its id), and everything downstream sees only deduplicated entries.
The plan has one shuffle on the hot path (dedup by id); the outputs share the
deduplicated rows through a reliable checkpoint so a lost executor recomputes
nothing twice and the four writes read one copy.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.functions.keys import partition_key
from driftlog.operators.decode import carried_columns, dead_letter, decode_all, encode_entry, split_decoded
from driftlog.operators.dedup import dedup_ttl
from driftlog.operators.normalise import is_valid, normalised
from driftlog.schemas import ENTRY_COLUMNS
from driftlog.sources.archive import archive
from driftlog.sources.hot import upsert_hot


@dataclass
class PipelineOutputs:
    normalized: DataFrame  # bus rows: key, value, timestamp (+ entry columns)
    entries: DataFrame     # deduplicated, normalised entries
    dead: DataFrame        # reason, payload, envelope


def process(raw: DataFrame, ttl_seconds: float = 300, value_col: str = "value",
            dedup_order: tuple[str, ...] = ("log_id",), parsed_once: bool = False) -> PipelineOutputs:
    """The transformation part of the pipeline (no writes).

    ``parsed_once``: checkpoint the decoded frame so the raw JSON is parsed once for
    both the entries and the dead letters (what ``run`` does).
    """
    carried = carried_columns(raw, value_col)
    all_rows = decode_all(raw, value_col)
    if parsed_once:
        all_rows = all_rows.checkpoint(eager=True)
    decoded, bad = split_decoded(all_rows, carried)
    ok = is_valid(decoded)
    good = normalised(decoded.filter(ok))
    rejected = decoded.filter(~ok)
    kept = dedup_ttl(good, ttl_seconds, order=list(dedup_order))
    bus = kept.select(
        partition_key(F.col("tenant_id"), F.col("service")).alias("key"),
        encode_entry().alias("value"),
        F.col("ingest_timestamp").alias("timestamp"),
        *[c for c in kept.columns],
    )
    return PipelineOutputs(normalized=bus, entries=kept, dead=dead_letter(bad, rejected))


def run(raw: DataFrame, out_dir: str, write_time: datetime | Column, batch_id: int = 0,
        ttl_seconds: float = 300) -> dict[str, int]:
    """Process and write the four outputs under ``out_dir``; idempotent per ``batch_id``.

    normalized/ and dead_letter/ get a batch_id=<n> directory overwritten as a
    whole; hot/ takes the batch as a generation, once; cold/ gets this
    batch's objects under batch_id=<n> as well.
    """
    out = process(raw, ttl_seconds, parsed_once=True)
    entries = out.entries.checkpoint(eager=True)
    bus = entries.select(
        partition_key(F.col("tenant_id"), F.col("service")).alias("key"),
        encode_entry().alias("value"), F.col("ingest_timestamp").alias("timestamp"), "log_id")
    # order per bus key inside every file (no shuffle: the bus itself keys by tenant|service)
    bus.sortWithinPartitions("key", "timestamp", "log_id").drop("log_id").write.mode("overwrite") \
        .parquet(f"{out_dir}/normalized/batch_id={batch_id}")
    out.dead.write.mode("overwrite").parquet(f"{out_dir}/dead_letter/batch_id={batch_id}")
    upsert_hot(entries.select(*ENTRY_COLUMNS), f"{out_dir}/hot", batch_id=batch_id)
    archive(entries, f"{out_dir}/cold/batch_id={batch_id}", write_time, mode="overwrite")
    spark = raw.sparkSession
    return {
        "normalized": spark.read.parquet(f"{out_dir}/normalized/batch_id={batch_id}").count(),
        "dead_letter": spark.read.parquet(f"{out_dir}/dead_letter/batch_id={batch_id}").count(),
    }
