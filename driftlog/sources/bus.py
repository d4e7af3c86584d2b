"""The message bus: Kafka-shaped rows in and out.

Rows have the Kafka source shape (topic, key, value, timestamp). The Kafka
connector jar is not part of this image, so ``kafka_source``/``kafka_sink``
need it on the classpath; ``file_source`` replays Kafka-shaped Parquet rows
and is what the tests use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from driftlog.functions.keys import partition_key
from driftlog.operators.decode import encode_entry
from driftlog.schemas import BUS_MESSAGE

# Fixed values (must equal the reference): topic names.
TOPIC_RAW = "logs-raw"
TOPIC_NORMALIZED = "logs-normalized"
TOPIC_DEAD_LETTER = "logs-dead-letter"


def kafka_source(spark: SparkSession, bootstrap: str, topics: str = TOPIC_RAW, **options) -> DataFrame:
    """Subscribe to topics as a stream (group offsets live in the query checkpoint)."""
    r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("subscribe", topics)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Kafka-shaped rows from Parquet files, for replay and tests."""
    return (spark.readStream.schema(BUS_MESSAGE).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def normalized_rows(entries: DataFrame, topic: str = TOPIC_NORMALIZED) -> DataFrame:
    """Each accepted entry keyed tenant|service, message time = ingest time."""
    return entries.select(
        F.lit(topic).alias("topic"),
        F.encode(partition_key(F.col("tenant_id"), F.col("service")), "UTF-8").alias("key"),
        F.encode(encode_entry(), "UTF-8").alias("value"),
        F.col("ingest_timestamp").alias("timestamp"),
    )


def dead_letter_rows(dead: DataFrame, topic: str = TOPIC_DEAD_LETTER) -> DataFrame:
    """Dead-letter envelopes: no key, no timestamp."""
    return dead.select(F.lit(topic).alias("topic"), F.lit(None).cast("binary").alias("key"),
                       F.encode(F.col("envelope"), "UTF-8").alias("value"))


def kafka_sink(rows: DataFrame, bootstrap: str, checkpoint: str) -> DataStreamWriter:
    """Synchronous, all-replica acknowledged, snappy-compressed publishing of (topic, key, value) rows."""
    return (rows.select("topic", "key", "value").writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap).option("kafka.acks", "all")
            .option("kafka.compression.type", "snappy").option("checkpointLocation", checkpoint))
