"""Strict decoding of raw batch messages, entry encoding, and dead-letter envelopes.

A message is one JSON object {agent_id, entries: [entry...], sent_at}. Any
error anywhere rejects the whole message: not exactly one JSON value, a
non-object top level, a non-array ``entries``, a non-object element, a
non-string in a string field or in ``fields``, or a time that is not RFC 3339.
A literal ``null`` message and a missing or null ``entries`` decode to zero
entries; a null element decodes to an empty entry (which validation then
rejects). Unknown keys are ignored. Every gate is a built-in expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.functions.jsonx import dead_letter_payload
from driftlog.functions.timefmt import RFC3339_RE, parse_rfc3339
from driftlog.schemas import ENTRY_STRING_FIELDS, ENTRY_TIME_FIELDS, OPTIONAL_STRING_FIELDS

# Fixed values (must equal the reference): dead-letter reasons (compared by prefix).
REASON_UNMARSHAL = "unmarshal error: "
REASON_NORMALISE = "normalise failed"
# A source's column with the detail of why a message is rejected unread, NULL for others.
REJECTED = "rejected"
# Fixed value: inflated request bodies above 10 MiB are rejected.
MAX_BODY_BYTES = 10 << 20


def _vtype(v: str) -> str:
    return f"schema_of_variant({v})"


def _string_ok(e: str, f: str) -> str:
    return f"coalesce({_vtype(f'variant_get({e}, {chr(39)}$.{f}{chr(39)})')} IN ('VOID', 'STRING'), true)"


def _time_ok(e: str, f: str) -> str:
    t = _vtype(f"variant_get({e}, '$.{f}')")
    s = f"try_variant_get({e}, '$.{f}', 'string')"
    return (f"(coalesce({t} = 'VOID', true) OR ({t} = 'STRING' AND {s} RLIKE '{RFC3339_RE}' "
            f"AND try_to_timestamp({s}) IS NOT NULL))")


def _fields_ok(e: str) -> str:
    t = _vtype(f"variant_get({e}, '$.fields')")
    m = f"try_variant_get({e}, '$.fields', 'map<string,variant>')"
    return (f"(coalesce({t} = 'VOID', true) OR ({t} LIKE 'OBJECT%' AND "
            f"forall(map_values({m}), x -> coalesce({_vtype('x')}, 'VOID') IN ('VOID', 'STRING'))))")


def _entry_ok(e: str) -> str:
    t = _vtype(e)
    checks = [_string_ok(e, f) for f in ENTRY_STRING_FIELDS] + [_time_ok(e, f) for f in ENTRY_TIME_FIELDS] + [
        _fields_ok(e)]
    return f"({t} = 'VOID' OR ({t} LIKE 'OBJECT%' AND " + " AND ".join(checks) + "))"


def _decode_reason(p: str) -> str:
    """SQL: NULL when the parsed message is acceptable, else the failure detail."""
    top = _vtype(p)
    et = _vtype(f"variant_get({p}, '$.entries')")
    arr = f"try_variant_get({p}, '$.entries', 'array<variant>')"
    return f"""CASE
      WHEN {top} = 'VOID' THEN NULL
      WHEN NOT ({top} LIKE 'OBJECT%') THEN 'cannot unmarshal ' || {top} || ' into LogBatch'
      WHEN NOT ({_string_ok(p, 'agent_id')}) THEN 'agent_id is not a string'
      WHEN NOT ({_time_ok(p, 'sent_at')}) THEN 'sent_at is not an RFC 3339 time'
      WHEN coalesce({et} = 'VOID', true) THEN NULL
      WHEN NOT ({et} LIKE 'ARRAY%') THEN 'entries is not an array'
      WHEN NOT forall({arr}, e -> {_entry_ok('e')}) THEN 'entry has a field of the wrong type'
      ELSE NULL END"""


def cap_body(v: Column, max_bytes: int = MAX_BODY_BYTES) -> Column:
    """Cut a body at ``max_bytes`` UTF-8 bytes, as a size-limited reader would; a character cut in two
    becomes U+FFFD."""
    b = F.encode(v, "UTF-8")
    cut = F.make_valid_utf8(F.substring(b, 1, max_bytes).cast("string"))
    return F.when(F.octet_length(v) > max_bytes, cut).otherwise(v)


# An acceptable entry's fields have these types or are null: one cast reads them all.
_ENTRY = "struct<" + ", ".join(f"{f}: string" for f in (*ENTRY_STRING_FIELDS, *ENTRY_TIME_FIELDS)) + ", fields: map<string, string>>"


def _entry_columns(e: str) -> list[Column]:
    """The entry columns of ``e``, an acceptable entry cast to ``_ENTRY``."""
    fields = F.coalesce(F.transform_values(f"{e}.fields", lambda k, x: F.coalesce(x, F.lit(""))), F.create_map().cast("map<string,string>"))
    return [*[F.coalesce(f"{e}.{f}", F.lit("")).alias(f) for f in ENTRY_STRING_FIELDS],
            *[parse_rfc3339(F.col(f"{e}.{f}")).alias(f) for f in ENTRY_TIME_FIELDS], fields.alias("fields")]


def _elements(parsed: str) -> Column:
    return F.coalesce(F.try_variant_get(F.col(parsed), "$.entries", "array<variant>"), F.array().cast("array<variant>"))


def entries_of(accepted: DataFrame, parsed: str) -> DataFrame:
    """A row per entry (``position`` and the entry columns) of messages that ``refused`` found acceptable, from
    their parsed values. Other columns are carried along."""
    carried = [c for c in accepted.columns if c != parsed]
    x = accepted.select(*carried, F.posexplode(_elements(parsed)).alias("position", "__e"))
    x = x.withColumn("__e", F.try_variant_get("__e", "$", _ENTRY))
    return x.select(*carried, "position", *_entry_columns("__e"))


def parsed_body(v: Column) -> Column:
    """The one JSON value that a text is, as variant; NULL if it is none or several."""
    # two parses decide "exactly one JSON value"; the array wrapper's only element is the value
    arr = F.try_parse_json(F.concat(F.lit("["), v, F.lit("]")))
    obj_ok = F.try_parse_json(F.concat(F.lit('{"a":'), v, F.lit("}"))).isNotNull()
    return F.when(arr.isNotNull() & obj_ok, F.variant_get(arr, "$[0]", "variant"))


def refused(parsed: str) -> Column:
    """Why a parsed message (a variant column) is no batch, or NULL."""
    return F.when(F.col(parsed).isNull(), F.lit("invalid JSON text")).otherwise(F.expr(_decode_reason(parsed)))


def carried_columns(raw: DataFrame, value_col: str) -> list[str]:
    return [c for c in raw.columns if c not in (value_col, REJECTED)]


def decode_all(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """One frame from one parse: a row per decoded entry (``kind = 'entry'``, with ``position``
    and the entry columns) and a row per rejected message (``kind = 'bad'``, with ``reason``
    and the raw ``value``). A ``rejected`` column (sources.files) that is not NULL rejects the
    message with that detail. Other input columns are carried along."""
    carried = carried_columns(raw, value_col)
    x = raw.withColumn("__v", F.col(value_col).cast("string"))
    x = x.withColumn("__p", parsed_body(F.col("__v"))).withColumn("__why", refused("__p"))
    if REJECTED in raw.columns:
        x = x.withColumn("__why", F.coalesce(REJECTED, "__why"))
    is_bad = F.col("__why").isNotNull()
    # a bad message keeps exactly one row (a NULL element); a good one a row per entry
    arr = F.when(is_bad, F.array(F.lit(None).cast("variant"))).otherwise(_elements("__p"))
    rows = x.select(
        *carried, F.when(is_bad, F.lit("bad")).otherwise(F.lit("entry")).alias("kind"),
        F.when(is_bad, F.concat(F.lit(REASON_UNMARSHAL), F.col("__why"))).alias("reason"),
        F.when(is_bad, F.col("__v")).alias("value"),
        F.when(~is_bad, F.coalesce(F.try_variant_get(F.col("__p"), "$.agent_id", "string"), F.lit(""))).alias("agent_id"),
        F.when(~is_bad, parse_rfc3339(F.try_variant_get(F.col("__p"), "$.sent_at", "string"))).alias("sent_at"),
        F.posexplode(arr).alias("position", "__e"),
    )
    rows = rows.withColumn("__e", F.try_variant_get("__e", "$", _ENTRY))
    return rows.select(*carried, "kind", "reason", "value", "agent_id", "sent_at", "position", *_entry_columns("__e"))


def split_decoded(decoded: DataFrame, carried: list[str]) -> tuple[DataFrame, DataFrame]:
    """(entries, bad) from ``decode_all`` output."""
    entry_cols = [c for c in decoded.columns if c not in ("kind", "reason", "value")]
    entries = decoded.filter(F.col("kind") == "entry").select(*entry_cols)
    bad = decoded.filter(F.col("kind") == "bad").select(*carried, "value", "reason")
    return entries, bad


def decode_batches(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(entries, bad): one row per decoded entry with its position, and one row per rejected
    message with ``reason`` and the raw ``value``. Other input columns are carried along.
    Both come from one ``decode_all`` frame (persist or checkpoint it to parse once)."""
    carried = carried_columns(raw, value_col)
    return split_decoded(decode_all(raw, value_col), carried)


def _rfc3339_nano(ts: Column) -> Column:
    """RFC 3339 in UTC with the fraction's trailing zeros trimmed; NULL -> the zero time."""
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.regexp_replace(F.date_format(ts, "SSSSSS"), "0+$", "")
    txt = F.concat(base, F.when(frac == "", F.lit("")).otherwise(F.concat(F.lit("."), frac)), F.lit("Z"))
    return F.coalesce(txt, F.lit("0001-01-01T00:00:00Z"))


def encode_entry(df: DataFrame | None = None) -> Column:
    """One entry as JSON text: optional strings and an empty ``fields`` are omitted."""
    parts = []
    for f in ENTRY_STRING_FIELDS:
        c = F.coalesce(F.col(f), F.lit(""))
        parts.append((F.when(c != "", c) if f in OPTIONAL_STRING_FIELDS else c).alias(f))
    for f in ENTRY_TIME_FIELDS:
        parts.append(_rfc3339_nano(F.col(f)).alias(f))
    parts.append(F.when(F.size(F.col("fields")) > 0, F.col("fields")).alias("fields"))
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "true"})


def dead_letter(bad: DataFrame | None = None, rejected: DataFrame | None = None) -> DataFrame:
    """Envelopes (reason, payload, envelope): undecodable messages keep their raw text (quoted
    as a JSON string when it is not JSON); rejected entries are re-encoded."""
    outs = []
    if bad is not None:
        outs.append(bad.select("reason", dead_letter_payload(F.col("value")).alias("payload")))
    if rejected is not None:
        outs.append(rejected.select(F.lit(REASON_NORMALISE).alias("reason"), encode_entry().alias("payload")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    # the payload is already JSON text: splice it in verbatim
    env = F.concat(F.lit('{"reason":'), F.to_json(F.array("reason")).substr(F.lit(2), F.length(
        F.to_json(F.array("reason"))) - 2), F.lit(',"payload":'), F.col("payload"), F.lit("}"))
    return out.withColumn("envelope", env)
