"""Deterministic log ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_id(agent_id: Column, line: Column, ts: Column) -> Column:
    """16 hex characters = first 8 bytes of SHA-256(agent id + line + event time in micros)."""
    text = F.concat(agent_id, line, F.unix_micros(ts).cast("string"))
    return F.substring(F.sha2(text, 256), 1, 16)
