"""Names derived from entries: bus partition key, day-partition name, archive object path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def partition_key(tenant_id: Column, service: Column) -> Column:
    """tenant + '|' + service (the ordering unit of the bus)."""
    return F.concat(F.coalesce(tenant_id, F.lit("")), F.lit("|"), F.coalesce(service, F.lit("")))


def index_name(tenant_id: Column, ts: Column) -> Column:
    """logs-<tenant>-<UTC day>."""
    return F.concat(F.lit("logs-"), tenant_id, F.lit("-"), F.date_format(ts, "yyyy-MM-dd"))


def archive_path(tenant_id: Column, ts: Column, part: Column) -> Column:
    """<tenant>/yyyy/MM/dd/HH/part-NNNNN.gz (the number widens past 99999)."""
    return F.format_string("%s/%s/part-%05d.gz", tenant_id, F.date_format(ts, "yyyy/MM/dd/HH"), part)
