"""Names derived per entry: bus key, day-partition (index) name, archive object path."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.functions.keys import archive_path, index_name, partition_key


def route_keys(entries: DataFrame, write_time: datetime | Column, part: int | Column) -> DataFrame:
    """Add ``partition_key`` (tenant|service), ``index_name`` (logs-<tenant>-<event day>) and
    ``archive_path`` (<tenant>/<write hour>/part-NNNNN.gz).

    The archive hour is the write (flush) time, not the event time; ``part`` is
    the flush sequence number, e.g. the micro-batch id, so it is deterministic.
    """
    wt = write_time if isinstance(write_time, Column) else F.lit(write_time)
    pt = part if isinstance(part, Column) else F.lit(int(part))
    return (
        entries.withColumn("partition_key", partition_key(F.col("tenant_id"), F.col("service")))
        .withColumn("index_name", index_name(F.col("tenant_id"), F.col("event_timestamp")))
        .withColumn("archive_path", archive_path(F.col("tenant_id"), wt, pt))
    )
