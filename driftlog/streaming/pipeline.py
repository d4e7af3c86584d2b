"""Streaming pipeline: raw batch messages -> normalized bus rows, hot table, cold archive, dead letters.

One streaming query. Decoding and validation are stateless; dedup is the
stateful ``dedup_stream``; the micro-batch is then split by kind and written
by ``foreachBatch``. Every write is idempotent per batch id (batch-id
directories are overwritten; the hot table takes a batch id once), and a ledger
holds a commit record per output and batch, so a retried micro-batch after a
lost executor or a restart writes what is missing and nothing else. The
checkpoint folder must be on shared storage.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftlog.functions.keys import partition_key
from driftlog.operators.decode import REASON_NORMALISE, decode_all, encode_entry
from driftlog.functions.jsonx import dead_letter_payload
from driftlog.functions.levels import canonical_level
from driftlog.operators.normalise import is_valid
from driftlog.schemas import ENTRY_COLUMNS
from driftlog.sources.bus import file_source, kafka_source  # noqa: F401  (re-exported)
from driftlog.sources.archive import archive
from driftlog.sources.files import Folder
from driftlog.sources.hot import upsert_hot
from driftlog.streaming.stateful import dedup_stream


def tagged_stream(raw: DataFrame, ttl_seconds: float = 300, watermark: str | None = None) -> DataFrame:
    """One stream of rows tagged kind = entry | rejected | bad, from one read and one parse.

    Payloads are built before normalisation (a rejected entry is re-encoded as it
    came); every row then passes the stateful dedup, where only valid entries
    are keyed by id and the other rows pass through untouched.
    """
    decoded = decode_all(raw.select(F.col("value").cast("string").alias("value")))
    ok = is_valid(decoded)
    kind = F.when(F.col("kind") == "bad", F.lit("bad")).when(ok, F.lit("entry")).otherwise(F.lit("rejected"))
    rows = decoded.withColumn("kind", kind).withColumn(
        "payload", F.when(F.col("kind") == "bad", dead_letter_payload(F.col("value")))
        .when(F.col("kind") == "rejected", encode_entry())).withColumn(
        "reason", F.when(F.col("kind") == "rejected", F.lit(REASON_NORMALISE)).otherwise(F.col("reason")))
    is_entry = F.col("kind") == "entry"
    # canonical level and event time, for entries only (rejected rows keep what they came with)
    norm = {"level": canonical_level(F.col("level")),
            "event_timestamp": F.coalesce(F.col("event_timestamp"), F.col("ingest_timestamp"))}
    rows = rows.select(
        "kind", "reason", "payload",
        *[(F.when(is_entry, norm[c]).otherwise(F.col(c)) if c in norm else F.col(c)).alias(c) for c in ENTRY_COLUMNS])
    deduped = dedup_stream(rows, ttl_seconds, watermark=watermark, passthrough=F.col("kind") != "entry")
    return deduped.withColumn("payload", F.when(F.col("kind") == "entry", encode_entry()).otherwise(F.col("payload")))


def write_normalized(entries: DataFrame, out_dir: str, batch_id: int, writer: str) -> None:
    """Bus rows, in order of arrival per key inside every file (the bus keys by tenant|service)."""
    bus = entries.select(partition_key(F.col("tenant_id"), F.col("service")).alias("key"),
                         encode_entry().alias("value"), F.col("ingest_timestamp").alias("timestamp"), "log_id")
    bus.sortWithinPartitions("key", "timestamp", "log_id").drop("log_id").write.mode("overwrite") \
        .parquet(f"{out_dir}/normalized/batch_id={batch_id}")


def write_hot(entries: DataFrame, out_dir: str, batch_id: int, writer: str) -> None:
    upsert_hot(entries, f"{out_dir}/hot", batch_id=batch_id, writer=writer)


def write_cold(entries: DataFrame, out_dir: str, batch_id: int, writer: str) -> None:
    # the flush hour is a function of the batch (its latest arrival), so a retry lands in place
    hour = entries.agg(F.max("ingest_timestamp").alias("h")).first()["h"]
    archive(entries, f"{out_dir}/cold/batch_id={batch_id}", F.lit(hour).cast("timestamp"), mode="overwrite")


def write_dead_letter(dead: DataFrame, out_dir: str, batch_id: int, writer: str) -> None:
    dead.write.mode("overwrite").parquet(f"{out_dir}/dead_letter/batch_id={batch_id}")


class Ledger:
    """Commit records, one for each output and batch id: an output that has one is not written again."""

    #: Batches whose records are kept; a query retries none but its last.
    KEEP = 100

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def done(self, output: str, batch_id: int) -> bool:
        return self.folder.exists(f"{output}/{batch_id:020d}")

    def commit(self, output: str, batch_id: int) -> None:
        self.folder.create(f"{output}/{batch_id:020d}")
        if batch_id % self.KEEP == 0:
            for name in sorted(self.folder.names(output)):
                if int(name) < batch_id - self.KEEP:
                    self.folder.delete(f"{output}/{name}")


@contextmanager
def _adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution within a micro-batch's writes: Spark turns it off for a stateful stream, and without it drops
    the ``rebalance`` of the hot table and the archive, so that every task writes a file into every tenant and day."""
    name = "spark.sql.adaptive.enabled"
    was = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, was)  # the stream's own plans are made without


def write_outputs(batch: DataFrame, batch_id: int, out_dir: str, writer: str = "query") -> None:
    """foreachBatch body: four outputs, each committed by itself.

    ``writer``: whose batch ids these are. An output that fails does not keep the others from being written; the batch then fails, and its retry
    writes the outputs without a commit record alone.
    """
    ledger = Ledger(batch.sparkSession, f"{out_dir}/ledger/{writer}")
    outputs = {"normalized": write_normalized, "hot": write_hot, "cold": write_cold, "dead_letter": write_dead_letter}
    left = [name for name in outputs if not ledger.done(name, batch_id)]
    if not left:
        return
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    failed = {}
    try:
        entries = batch.filter(F.col("kind") == "entry").select(*ENTRY_COLUMNS)
        dead = batch.filter(F.col("kind") != "entry").select("reason", "payload")
        some = not entries.isEmpty()
        for name in left:
            try:
                with _adaptive(batch.sparkSession):
                    if name == "dead_letter":
                        outputs[name](dead, out_dir, batch_id, writer)
                    elif some or name == "normalized":
                        outputs[name](entries, out_dir, batch_id, writer)
                ledger.commit(name, batch_id)
            except Exception as e:  # noqa: BLE001 - the other outputs are written first, then it is raised
                failed[name] = e
    finally:
        batch.unpersist()
    if failed:
        raise RuntimeError(f"batch {batch_id}: {', '.join(failed)} not written") from next(iter(failed.values()))


def stream_pipeline(raw: DataFrame, out_dir: str, checkpoint: str, ttl_seconds: float = 300,
                    watermark: str | None = None, available_now: bool = False,
                    processing_time: str | None = None) -> StreamingQuery:
    """Start the streaming pipeline; returns the running query.

    Without a ``watermark`` every message ends in ``normalized``, in ``dead_letter`` or is a
    repeat of an entry seen within the TTL, however late it comes.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        # the id that the query keeps over restarts: a query with a new checkpoint counts its batches anew
        query = json.loads(Folder(batch.sparkSession, checkpoint).text("metadata"))["id"]
        write_outputs(batch, batch_id, out_dir, query)

    w = tagged_stream(raw, ttl_seconds, watermark).writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
