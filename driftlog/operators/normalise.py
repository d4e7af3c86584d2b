"""Validation and canonical form of decoded entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.functions.levels import canonical_level


def is_valid(df: DataFrame) -> Column:
    """An entry needs a tenant and a message ('  ' is a message; no trimming)."""
    return (F.coalesce(F.col("tenant_id"), F.lit("")) != "") & (F.coalesce(F.col("message"), F.lit("")) != "")


def normalised(df: DataFrame) -> DataFrame:
    """Canonical level and event time for rows already known to be valid."""
    return (
        df.withColumn("level", canonical_level(F.col("level")))
        .withColumn("event_timestamp", F.coalesce(F.col("event_timestamp"), F.col("ingest_timestamp")))
    )


def normalise(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split entries into (normalised good rows, rejected rows as they came)."""
    ok = is_valid(df)
    good = normalised(df.filter(ok))
    rejected = df.filter(~ok)
    return good, rejected
