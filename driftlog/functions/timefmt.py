"""RFC 3339 parsing/formatting and UTC calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the RFC 3339 date-time shape (T separator, optional fraction, Z or offset).
RFC3339_RE = (
    "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}"
    "(\\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
)


def rfc3339_text(c: Column) -> Column:
    """True when the text has RFC 3339 form."""
    return F.coalesce(c.rlike(RFC3339_RE), F.lit(False))


# Fixed value: the zero instant 0001-01-01T00:00:00Z in micros, which means "missing".
ZERO_TIME_MICROS = -62135596800000000


def parse_rfc3339(c: Column) -> Column:
    """Timestamp from RFC 3339 text; NULL when malformed or exactly the zero instant."""
    ts = F.when(rfc3339_text(c), F.try_to_timestamp(c))
    return F.when(F.unix_micros(ts) != ZERO_TIME_MICROS, ts)


def unless_zero(ts: Column) -> Column:
    """The time, NULL for the zero instant, which stands for a missing one."""
    return F.when(F.unix_micros(ts) != ZERO_TIME_MICROS, ts)


def format_rfc3339(ts: Column) -> Column:
    """Second-precision UTC text, e.g. 2024-01-01T00:00:07Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def floor_second(ts: Column) -> Column:
    return F.date_trunc("second", ts)


def utc_day(ts: Column) -> Column:
    return F.to_date(ts)
