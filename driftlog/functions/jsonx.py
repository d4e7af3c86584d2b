"""Strict JSON checks and quoting, all as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_single_json(v: Column) -> Column:
    """True when the text is exactly one JSON value.

    Parsers stop after the first value, so the text is parsed inside two
    different wrappers; trailing garbage cannot close both ']' and '}' at once.
    """
    arr = F.try_parse_json(F.concat(F.lit("["), v, F.lit("]")))
    obj = F.try_parse_json(F.concat(F.lit('{"a":'), v, F.lit("}")))
    return F.coalesce(arr.isNotNull() & obj.isNotNull(), F.lit(False))


def json_quote(v: Column) -> Column:
    """The text encoded as one JSON string literal."""
    arr = F.to_json(F.array(v))
    return arr.substr(F.lit(2), F.length(arr) - 2)


def dead_letter_payload(v: Column) -> Column:
    """Payload kept verbatim when it is valid JSON, else quoted as a JSON string."""
    return F.when(is_single_json(v), v).otherwise(json_quote(F.coalesce(v, F.lit(""))))
