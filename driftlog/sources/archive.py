"""Cold archive: gzip JSON lines under <root>/tenant=<t>/yyyy=/mm=/dd=/hh=/ (write hour).

One flush writes one set of objects per tenant and hour; ``tenant_id`` stays
in every record as well as in the path. Reading prunes on the path columns.

Objects lie by write hour and searches go by event time, so ``index_archive`` keeps a zone map beside
them: the first and last event time of each object. A read with bounds opens the objects whose zone
overlaps them, and those not indexed yet.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog.functions.timefmt import unless_zero
from driftlog.operators.decode import encode_entry
from driftlog.schemas import ENTRY_COLUMNS, LOG_ENTRY
from driftlog.sources.files import Folder

ARCHIVE_PARTITIONS = ["tenant", "yyyy", "mm", "dd", "hh"]
_PARTITION_SCHEMA = ", ".join(f"{c} string" for c in ARCHIVE_PARTITIONS)
#: Of one object: its path, tenant, first and last event time in microseconds (null: no entry has one), entries.
ZONE = "object string, tenant string, first_us long, last_us long, entries long"
ZONES = "_zones"  # a name that readers of the archive skip
_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"}


def archive_rows(entries: DataFrame, write_time: datetime | Column) -> DataFrame:
    """The JSON text per entry plus the partition columns of its archive object."""
    wt = write_time if isinstance(write_time, Column) else F.lit(write_time)
    return entries.select(
        encode_entry().alias("value"),
        F.col("tenant_id").alias("tenant"),
        F.date_format(wt, "yyyy").alias("yyyy"), F.date_format(wt, "MM").alias("mm"),
        F.date_format(wt, "dd").alias("dd"), F.date_format(wt, "HH").alias("hh"),
    )


def archive(entries: DataFrame, path: str, write_time: datetime | Column, mode: str = "append") -> None:
    """Write entries as gzip NDJSON partitioned by tenant and write hour.

    ``rebalance`` clusters rows by (tenant, hour) so each task writes few objects,
    and lets AQE split a hot tenant's hour over several tasks and files.
    """
    rows = archive_rows(entries, write_time)
    (rows.hint("rebalance", *ARCHIVE_PARTITIONS).write.mode(mode)
     .partitionBy(*ARCHIVE_PARTITIONS).option("compression", "gzip").text(path))


def _objects(spark: SparkSession, path: str) -> DataFrame:
    """Paths of all objects (a listing: their content is not read)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select(F.col("path").alias("object"))


def _zones(spark: SparkSession, path: str) -> DataFrame:
    if not Folder(spark, path).exists(ZONES):
        return spark.createDataFrame([], ZONE)
    return spark.read.schema(ZONE).parquet(f"{path}/{ZONES}")


def index_archive(spark: SparkSession, path: str) -> int:
    """Add the objects that have no zone yet to the zone map; returns how many."""
    new = [r["object"] for r in _objects(spark, path).join(_zones(spark, path), "object", "left_anti").collect()]  # one flush's objects
    if not new:
        return 0
    rows = spark.read.schema("value string, " + _PARTITION_SCHEMA).option("basePath", path).text(new)
    at = F.unix_micros(unless_zero(F.from_json("value", "event_timestamp timestamp", _TIME)["event_timestamp"]))
    zones = rows.select(F.col("_metadata.file_path").alias("object"), "tenant", at.alias("us")).groupBy("object", "tenant").agg(
        F.min("us").alias("first_us"), F.max("us").alias("last_us"), F.count("*").alias("entries"))
    zones.coalesce(1).write.mode("append").parquet(f"{path}/{ZONES}")
    return len(new)


def overlapping(spark: SparkSession, path: str, tenant: str | None, from_ts: datetime, to_ts: datetime) -> list[str]:
    """Objects that can hold entries of the tenant with an event time in [from_ts, to_ts]."""
    zones = _zones(spark, path)
    lo, hi = (F.unix_micros(F.lit(t).cast("timestamp")) for t in (from_ts, to_ts))
    hit = zones.where((F.col("first_us") <= hi) & (F.col("last_us") >= lo))
    if tenant is not None:
        hit = hit.where(F.col("tenant") == tenant)
    open_ = _objects(spark, path).join(zones, "object", "left_anti")
    return [r["object"] for r in hit.select("object").unionByName(open_).collect()]


def read_archive(spark: SparkSession, path: str, tenant: str | None = None, from_ts: datetime | None = None,
                 to_ts: datetime | None = None) -> DataFrame:
    """Entries back from the archive (tenant filter prunes directories), with the write hour.

    With ``from_ts`` and ``to_ts`` only objects whose zone overlaps them are opened; rows outside come with them.
    A missing time is written as the zero time (year 1) and comes back missing.
    """
    # explicit schema: partition values stay strings (a tenant "007" is not the number 7)
    schema = "value string, " + _PARTITION_SCHEMA
    if from_ts is not None and to_ts is not None:
        paths = overlapping(spark, path, tenant, from_ts, to_ts)
        raw = (spark.read.schema(schema).option("basePath", path).text(paths) if paths
               else spark.createDataFrame([], schema))
    else:
        raw = spark.read.schema(schema).option("basePath", path).text(path)
    if tenant is not None:
        raw = raw.filter(F.col("tenant") == tenant)
    parsed = raw.select(F.from_json("value", LOG_ENTRY, _TIME).alias("e"),
                        "tenant", "yyyy", "mm", "dd", "hh")
    out = parsed.select(
        *[F.coalesce(F.col(f"e.{c}"), F.lit("")).alias(c) if c not in ("event_timestamp", "ingest_timestamp", "fields")
          else (F.col(f"e.{c}") if c == "fields" else unless_zero(F.col(f"e.{c}"))).alias(c) for c in ENTRY_COLUMNS],
        F.make_timestamp(F.col("yyyy").cast("int"), F.col("mm").cast("int"), F.col("dd").cast("int"),
                         F.col("hh").cast("int"), F.lit(0), F.lit(0)).alias("archived_hour"),
    )
    return out.withColumn("fields", F.coalesce(F.col("fields"), F.create_map().cast("map<string,string>")))
