"""Dedup that remembers ids between batch runs: a table of seen ids in partitions of their expiry.

A run reads the live partitions alone (an id expires ``ttl`` after its first sight), and of those the ids that its
own entries bring (a semi join; on large tables Spark adds a Bloom filter of the batch's ids to the scan of the
seen ones). They take part in the fold as entries from before, so a repeat is judged exactly as if all batches
were one. What the run keeps is written as seen under its batch id: the same batch again sees no ids of its own
and overwrites them. Batch ids ascend, and batches come in order of arrival; there is one writer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog.operators.dedup import dedup_ttl
from driftlog.session import ensure_checkpoint_dir
from driftlog.sources.files import Folder

#: Width of an expiry partition in seconds.
BUCKET_SECONDS = 3_600
_SEEN = "key string, first_us long, batch long, expiry long"


class SeenIds:
    """The seen ids in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str, ttl_seconds: float = 300, keys: Sequence[str] = ("log_id",)):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.ttl_us = int(ttl_seconds * 1_000_000)
        self.folder = Folder(spark, self.path)

    def _expiry(self, us):
        return F.floor((us + self.ttl_us) / (BUCKET_SECONDS * 1_000_000))

    def live(self, since_us: int, before_batch: int) -> DataFrame:
        """Ids whose time is not over at ``since_us``, of earlier batches."""
        if not self.folder.names(""):
            return self.spark.createDataFrame([], _SEEN)
        rows = self.spark.read.schema(_SEEN).option("basePath", self.path).parquet(self.path)
        open_ = F.col("expiry") >= since_us // (BUCKET_SECONDS * 1_000_000)  # a partition filter
        return rows.where(open_ & (F.col("batch") < before_batch) & (F.col("first_us") + self.ttl_us > since_us))

    def dedup(self, entries: DataFrame, batch_id: int, arrival: str = "ingest_timestamp", order: Sequence[str] = ("log_id",)) -> DataFrame:
        """The entries of this batch that no entry before them, here or in an earlier batch, makes a repeat."""
        ensure_checkpoint_dir(self.spark)
        us = F.unix_micros(F.col(arrival))
        key = F.to_json(F.struct(*self.keys))
        counted = (F.coalesce(F.col("log_id"), F.lit("")) != "") & F.col(arrival).isNotNull()
        now = entries.withColumns({"__key": F.when(counted, key), "__seen": F.lit(False)})
        since = now.where(counted).agg(F.min(us)).first()[0]
        if since is None:
            return entries
        before = self.live(since, batch_id).join(now.where(counted).select(F.col("__key").alias("key")).distinct(), "key", "left_semi")
        old = before.select(*[
            F.timestamp_micros("first_us").alias(f.name) if f.name == arrival
            else F.lit(True).alias(f.name) if f.name == "__seen"
            else F.col("key").alias(f.name) if f.name in ("__key", "log_id")
            else F.lit(None).cast(f.dataType).alias(f.name) for f in now.schema.fields])
        kept = dedup_ttl(old.unionByName(now), self.ttl_us / 1_000_000, keys=["__key"], arrival=arrival, order=["__seen", *order])
        kept = kept.where(~F.col("__seen")).checkpoint(eager=True)  # what is recorded is what is returned
        mark = kept.where(counted).select(F.col("__key").alias("key"), us.alias("first_us"), self._expiry(us).alias("expiry"))
        (mark.hint("rebalance", "expiry").sortWithinPartitions("expiry", "key").write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("expiry").parquet(f"{self.path}/batch={batch_id:020d}"))
        return kept.drop("__key", "__seen")

    def forget(self, before_us: int) -> None:
        """Delete the partitions that expired before a time."""
        limit = before_us // (BUCKET_SECONDS * 1_000_000)
        for batch in self.folder.names(""):
            for part in self.folder.names(batch):
                if part.startswith("expiry=") and int(part.split("=")[1]) < limit:
                    self.folder.delete(f"{batch}/{part}")
