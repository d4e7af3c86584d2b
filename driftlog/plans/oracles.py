"""Independent DuckDB SQL for every registered query (the correctness gate).

These are written from the semantics, not from the Spark code: anchored
windows are a recursive hop over "first event past the window end" (a range
window frame), the token bucket is a recursive step per request, paging is
ORDER BY ... LIMIT/OFFSET or row_number. Tables are the driver's views.
"""

from __future__ import annotations

from driftlog import fixtures as fx
from driftlog.plans import catalog as cat

US = 1_000_000


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Unicode white space class (RE2 form), as in the level trim.
_WS = r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _trim(x: str) -> str:
    return "regexp_replace(" + x + ", '^" + _WS + "+|" + _WS + "+$', '', 'g')"
_RFC = r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})"


def _tok(x: str) -> str:
    return r"list_filter(regexp_split_to_array(lower(" + x + r"), '[^\p{L}\p{N}_]+'), lambda t: t <> '')"


def _level_case(x: str) -> str:
    out = "CASE "
    for w in ["ERROR", "WARN", "INFO", "DEBUG", "FATAL"]:
        pat = "".join(f"[{c}{c.lower()}]" for c in w)
        out += f"WHEN regexp_matches({x}, '{pat}') THEN '{w}' "
    return out + "ELSE 'INFO' END"


REPLAYS = ", ".join(f"({s}, {m})" for s, m in fx.REPLAYS)
LEVELS = " ".join(f"WHEN {_q(k)} THEN {_q(v).replace(chr(9), chr(39) + ' || chr(9) || ' + chr(39))}"
                  for k, v in fx.LEVEL_BY_TYPE.items())

LOG_ENTRIES = f"""
replays(shift, m) AS (VALUES {REPLAYS}),
log_entries AS (
  SELECT
    CASE WHEN e.event_id % 89 = 0 THEN '' ELSE 'e' || e.event_id::VARCHAR END AS log_id,
    CASE WHEN e.event_id % 97 = 0 THEN '' ELSE 'tenant-' || (e.user_id % 4)::VARCHAR END AS tenant_id,
    e.event_type AS service,
    'h' || (e.user_id % 10)::VARCHAR AS host,
    CASE e.event_type {LEVELS} ELSE '' END AS level,
    CASE WHEN e.event_id % 101 = 0 THEN '' ELSE e.event_type || ' k=' || json_extract_string(e.props, '$.k') END AS message,
    CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE epoch_us(e.ts) END AS event_us0,
    epoch_us(e.ts) + ((e.event_id % 30) + r.shift) * {US} AS ingest_us,
    r.shift::BIGINT AS shift,
    e.event_id,
    json_extract_string(e.props, '$.k') AS k
  FROM events e JOIN replays r ON e.event_id % r.m = 0),
nv AS (
  SELECT log_id, tenant_id, service, host,
    CASE WHEN {_trim('level')} = '' THEN 'INFO' ELSE upper({_trim('level')}) END AS level,
    message, coalesce(event_us0, ingest_us) AS event_us, ingest_us, shift, event_id, k
  FROM log_entries WHERE tenant_id <> '' AND message <> '')"""

DEDUP = f"""
kd AS (SELECT * FROM nv WHERE log_id <> ''),
dnx AS MATERIALIZED (
  SELECT DISTINCT log_id AS k, ingest_us AS us,
    min(ingest_us) OVER (PARTITION BY log_id ORDER BY ingest_us
      RANGE BETWEEN {cat.DEDUP_TTL_S * US} FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
  FROM kd),
dchain(k, a) AS (
  SELECT k, min(us) FROM dnx GROUP BY k
  UNION ALL
  SELECT n.k, n.nxt FROM dchain c JOIN dnx n ON n.k = c.k AND n.us = c.a WHERE n.nxt IS NOT NULL),
dkept AS (
  SELECT kd.* FROM kd JOIN dchain c ON c.k = kd.log_id AND c.a = kd.ingest_us
  QUALIFY row_number() OVER (PARTITION BY kd.log_id, kd.ingest_us ORDER BY kd.shift) = 1),
dd AS (SELECT * FROM dkept UNION ALL SELECT * FROM nv WHERE log_id = '')"""

BASE = "WITH RECURSIVE " + LOG_ENTRIES + "," + DEDUP

RULES = ", ".join(
    f"({_q(n)}, {_q(t)}, {_q(lv)}, {_q(nd)}, {th}, {ws}, {_q(wh)}, {i})"
    for i, (n, t, lv, nd, th, ws, wh) in enumerate(fx.RULES))
RULE_NX = "\n  UNION ALL\n  ".join(
    f"""SELECT DISTINCT name, tenant_id, ingest_us AS us,
    min(ingest_us) OVER (PARTITION BY name, tenant_id ORDER BY ingest_us
      RANGE BETWEEN {ws * US + 1} FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
  FROM m WHERE name = {_q(n)}""" for (n, _t, _lv, _nd, _th, ws, _wh) in fx.RULES)

ALERTS = f"""
rules(name, rtenant, rlevel, needle, threshold, wsec, webhook, rule_pos) AS (VALUES {RULES}),
m AS (
  SELECT d.*, r.* FROM dd d JOIN rules r
    ON (r.rtenant = '*' OR r.rtenant = d.tenant_id)
   AND (r.rlevel = '' OR (length(r.rlevel) = length(d.level)
        AND (lower(r.rlevel) = lower(d.level) OR upper(r.rlevel) = upper(d.level))))
   AND contains(lower(d.message), lower(r.needle))),
anx AS MATERIALIZED (
  {RULE_NX}),
achain(name, tenant_id, a) AS (
  SELECT name, tenant_id, min(us) FROM anx GROUP BY name, tenant_id
  UNION ALL
  SELECT n.name, n.tenant_id, n.nxt FROM achain c JOIN anx n
    ON n.name = c.name AND n.tenant_id = c.tenant_id AND n.us = c.a WHERE n.nxt IS NOT NULL),
lab AS (
  SELECT m.*, max(CASE WHEN c.a IS NOT NULL THEN m.ingest_us END) OVER (
      PARTITION BY m.name, m.tenant_id ORDER BY m.ingest_us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS anchor
  FROM m LEFT JOIN achain c ON c.name = m.name AND c.tenant_id = m.tenant_id AND c.a = m.ingest_us),
cnt AS (
  SELECT lab.*, row_number() OVER (PARTITION BY name, tenant_id, anchor
      ORDER BY ingest_us, log_id, shift, rule_pos) AS count FROM lab)"""

# epoch-aligned tumbling windows of each rule's width (the optional aligned mode)
ALIGNED = f"""
rules(name, rtenant, rlevel, needle, threshold, wsec, webhook, rule_pos) AS (VALUES {RULES}),
m AS (
  SELECT d.*, r.* FROM dd d JOIN rules r
    ON (r.rtenant = '*' OR r.rtenant = d.tenant_id)
   AND (r.rlevel = '' OR (length(r.rlevel) = length(d.level)
        AND (lower(r.rlevel) = lower(d.level) OR upper(r.rlevel) = upper(d.level))))
   AND contains(lower(d.message), lower(r.needle))),
acnt AS (
  SELECT m.*, ingest_us - (ingest_us % (wsec::BIGINT * {US})) AS wstart,
    row_number() OVER (PARTITION BY name, tenant_id, ingest_us - (ingest_us % (wsec::BIGINT * {US}))
                       ORDER BY ingest_us, log_id, shift, rule_pos) AS count
  FROM m)"""

NOW_US = "epoch_us(TIMESTAMPTZ '2024-01-30 00:00:00+00')"


def _parse_ts(col: str) -> str:
    p = f"epoch_us(try_cast({col} AS TIMESTAMPTZ))"
    return f"CASE WHEN regexp_full_match({col}, '{_RFC}') AND {p} <> -62135596800000000 THEN {p} END"


def _int(col: str) -> str:
    return f"CASE WHEN regexp_full_match({col}, '[+-]?[0-9]+') THEN try_cast({col} AS BIGINT) END"


REQUESTS = f"""
rdays AS (SELECT DISTINCT 'tenant-' || (user_id % 4)::VARCHAR AS tenant_id, CAST(ts AS DATE) AS day FROM events),
reqs AS (
  SELECT tenant_id || '@' || strftime(day, '%Y-%m-%d') AS request_id, tenant_id,
    CASE WHEN dayofmonth(day) % 5 = 1 THEN 'view' ELSE '' END AS service,
    CASE WHEN dayofmonth(day) % 5 = 0 THEN 'ERROR' ELSE '' END AS level,
    CASE WHEN dayofmonth(day) % 5 = 2 THEN 'k=7 k=42' ELSE '' END AS q,
    CASE WHEN dayofmonth(day) % 7 = 0 THEN 'yesterday' ELSE strftime(day, '%Y-%m-%d') || 'T00:00:00.900Z' END AS rfrom,
    CASE WHEN dayofmonth(day) % 11 = 0 THEN 'garbage'
         ELSE strftime(day + INTERVAL 1 DAY, '%Y-%m-%d') || 'T06:00:00Z' END AS rto,
    CASE WHEN dayofmonth(day) % 5 = 3 THEN '2' WHEN dayofmonth(day) % 13 = 0 THEN 'abc' ELSE '1' END AS page,
    CASE WHEN dayofmonth(day) % 5 = 3 THEN '50' WHEN dayofmonth(day) % 5 = 4 THEN '9999'
         WHEN dayofmonth(day) % 9 = 0 THEN '0' ELSE '20' END AS page_size
  FROM rdays),
r1 AS (SELECT *, coalesce({_parse_ts('rto')}, {NOW_US}) AS to_us FROM reqs),
routed AS (
  SELECT *,
    coalesce({_parse_ts('rfrom')}, to_us - {3600 * US}) AS from_us,
    CASE WHEN {_int('page')} > 0 THEN {_int('page')} ELSE 1 END AS page_no,
    CASE WHEN {_int('page_size')} > 0 AND {_int('page_size')} <= 1000 THEN {_int('page_size')} ELSE 100 END AS size
  FROM r1),
routed2 AS (
  SELECT *, CASE WHEN from_us > {NOW_US} - {30 * 86400 * US} THEN 'hot' ELSE 'cold' END AS tier,
    from_us - (from_us % {US}) AS lo_us, to_us - (to_us % {US}) AS hi_us
  FROM routed),
hits AS (
  SELECT r.request_id, r.page_no, r.size, d.* FROM routed2 r JOIN dd d
    ON d.tenant_id = r.tenant_id AND d.event_us >= r.lo_us AND d.event_us <= r.hi_us
   AND (r.service = '' OR d.service = r.service) AND (r.level = '' OR d.level = r.level)
   AND (r.q = '' OR len(list_intersect({_tok('d.message')}, {_tok('r.q')})) > 0))"""

PREFIX_CASE = "CASE (doc_id + pos) % 8 " + " ".join(
    f"WHEN {i} THEN {_q(p)}" for i, p in enumerate(fx.LINE_PREFIXES)) + " END"

LINES = f"""
docs AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(range(len(parts)))::BIGINT AS pos, unnest(parts) AS body FROM docs),
pl AS (
  SELECT doc_id, pos, 'a' || doc_id::VARCHAR AS agent_id, ({PREFIX_CASE}) || body AS line,
    1704067200000000 + doc_id * 60000000 + pos * 1000 AS ts_us
  FROM lines),
ple AS (
  SELECT doc_id, pos, agent_id, substr(sha256(agent_id || line || ts_us::VARCHAR), 1, 16) AS log_id,
    CASE WHEN line = '' THEN 'INFO' ELSE {_level_case('line')} END AS level, line AS message, ts_us AS event_us
  FROM pl),
ab AS (
  SELECT *, row_number() OVER (PARTITION BY agent_id ORDER BY event_us, log_id) - 1 AS rn0 FROM ple)"""

_EDGE_BAD = ["c01", "c02", "c05", "c06", "c07", "c10", "c11", "c12", "c13", "c15", "c16", "c17", "c18", "c19",
             "c20", "c22", "c23", "c24"]
_EDGE_NOT_JSON = ["c01", "c02", "c15", "c16", "c17", "c18", "c19", "c20"]
EDGE_VALUES = ", ".join(f"({_q(i)}, {_q(v)})" for i, v in fx.EDGE_BATCHES)

# expected decoded entries of the edge texts that decode
# (batch_id, position, agent, log_id, tenant, service, host, env, level, message, event_us, ingest_us)
_EDGE_DECODED = """
  ('c09', 0, '', '', '', '', '', '', '', '', NULL::BIGINT, NULL::BIGINT),
  ('c14', 0, '', 'edge-ok', 'tenant-0', 'svc', '', '', ' warn' || chr(160), 'ok',
     epoch_us(TIMESTAMPTZ '2024-01-01 21:34:05.123456+00'), NULL::BIGINT),
  ('c21', 0, '', 'edge-zero', 'tenant-1', '', '', '', '', 'z', NULL::BIGINT, epoch_us(TIMESTAMPTZ '2024-01-05 00:00:00+00')),
  ('c25', 0, '', 'edge-blank', 'tenant-2', '', '', '', '', ' ', NULL::BIGINT, epoch_us(TIMESTAMPTZ '2024-01-05 00:00:00+00')),
  ('c25', 1, '', 'edge-notenant', '', '', '', '', '', 'm', NULL::BIGINT, NULL::BIGINT)"""

DECODED = f"""
dec AS (
  SELECT 'b' || conv_id::VARCHAR || '-' || (turn // 100)::VARCHAR AS batch_id,
    (row_number() OVER (PARTITION BY conv_id, turn // 100 ORDER BY turn) - 1)::BIGINT AS position,
    'a' || conv_id::VARCHAR AS agent_id, conv_id::VARCHAR || '-' || turn::VARCHAR AS log_id,
    'tenant-' || (conv_id % 4)::VARCHAR AS tenant_id, role AS service, 'h1' AS host, 'test' AS environment,
    CASE WHEN role = 'user' THEN 'info' ELSE 'debug' END AS level, text AS message,
    1704067200000000 + conv_id * 60000000 + turn * 1000000 AS event_us,
    1704067200000000 + conv_id * 60000000 + turn * 1000000 + 1000000 AS ingest_us
  FROM conversations
  UNION ALL
  SELECT * FROM (VALUES {_EDGE_DECODED}) v(batch_id, position, agent_id, log_id, tenant_id, service, host,
                                            environment, level, message, event_us, ingest_us))"""


def _ts_json(col: str) -> str:
    frac = f"rtrim(lpad(({col} % {US})::VARCHAR, 6, '0'), '0')"
    return (f"CASE WHEN {col} IS NULL THEN '\"0001-01-01T00:00:00Z\"' ELSE '\"' || "
            f"strftime(make_timestamp({col}), '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN {col} % {US} = 0 THEN '' ELSE '.' || {frac} END || 'Z\"' END")


ENTRY_JSON = ("'{\"log_id\":' || to_json(log_id) || ',\"tenant_id\":' || to_json(tenant_id) || "
              "',\"service\":' || to_json(service) || ',\"host\":' || to_json(host) || "
              "',\"environment\":' || to_json(environment) || ',\"level\":' || to_json(level) || "
              "',\"message\":' || to_json(message) || ',\"event_timestamp\":' || " + _ts_json("event_us") +
              " || ',\"ingest_timestamp\":' || " + _ts_json("ingest_us") + " || '}'")

# dead letters: the edge texts, what was damaged by row (0 cut, 1 a bad time, 2 a number for a string, 3 no
# tenant), and entries without tenant or message
DEAD = f"""edges(batch_id, value) AS (VALUES {EDGE_VALUES}),
dmg AS (SELECT 'd' || conv_id::VARCHAR || '-' || turn::VARCHAR AS id, to_json(text)::VARCHAR AS t, (conv_id * 7 + turn) % 40 AS kind
  FROM conversations WHERE (conv_id * 7 + turn) % 40 < 4),
dead AS (
  SELECT 'unmarshal error' AS reason_kind,
    CASE WHEN batch_id IN ({", ".join(_q(i) for i in _EDGE_NOT_JSON)}) THEN to_json(value)::VARCHAR ELSE value END AS payload
  FROM edges WHERE batch_id IN ({", ".join(_q(i) for i in _EDGE_BAD)})
  UNION ALL
  SELECT CASE WHEN kind = 3 THEN 'normalise failed' ELSE 'unmarshal error' END,
    CASE kind WHEN 0 THEN to_json('{{"entries":[{{"message":' || t)::VARCHAR
      WHEN 1 THEN '{{"entries":[{{"message":' || t || ',"event_timestamp":"yesterday"}}]}}'
      WHEN 2 THEN '{{"entries":[{{"tenant_id":7,"message":' || t || '}}]}}'
      ELSE '{{"log_id":"' || id || '","tenant_id":"","service":"","host":"","environment":"","level":"","message":' || t ||
        ',"event_timestamp":"0001-01-01T00:00:00Z","ingest_timestamp":"0001-01-01T00:00:00Z"}}' END
  FROM dmg
  UNION ALL
  SELECT 'normalise failed', ({ENTRY_JSON})::VARCHAR FROM dec WHERE tenant_id = '' OR message = '')"""

# accepted entries as they leave: level upper-cased and trimmed, event time from the arrival where it is missing
VALID = f"""okd AS (
  SELECT batch_id, position, log_id, tenant_id, service, host, environment,
    CASE WHEN {_trim('level')} = '' THEN 'INFO' ELSE upper({_trim('level')}) END AS level, message,
    coalesce(event_us, ingest_us) AS event_us, ingest_us FROM dec WHERE tenant_id <> '' AND message <> ''),
bus AS (
  SELECT tenant_id, log_id, tenant_id || '|' || service AS key, ingest_us AS time_us,
    CASE WHEN log_id = 'edge-ok' THEN left(({ENTRY_JSON})::VARCHAR, -1) || ',"fields":{{"a":"b","c":""}}}}' ELSE ({ENTRY_JSON})::VARCHAR END AS value
  FROM okd)"""

ORACLES: dict[str, str] = {
    "normalise": BASE + """
SELECT log_id, tenant_id, service, level, message, event_us, ingest_us, shift, event_id FROM nv""",

    "dedup_ttl": BASE + """
SELECT log_id, tenant_id, shift, event_id, ingest_us FROM dd""",

    "evaluate_rules": BASE + "," + ALERTS + """
SELECT name AS rule, tenant_id, service, count::BIGINT AS count, ingest_us AS fired_us, message AS sample_message,
       webhook, log_id, anchor AS window_start_us
FROM cnt WHERE count >= threshold""",

    "alerts_first": BASE + "," + ALERTS + """
SELECT name AS rule, tenant_id, log_id, count::BIGINT AS count, ingest_us AS fired_us, anchor AS window_start_us
FROM cnt WHERE count >= threshold AND count = greatest(threshold, 1)""",

    "alerts_aligned": BASE + "," + ALIGNED + """
SELECT name AS rule, tenant_id, log_id, count::BIGINT AS count, ingest_us AS fired_us, wstart AS window_start_us
FROM acnt WHERE count >= threshold""",

    "rule_windows": BASE + "," + ALERTS + """
SELECT name AS rule, tenant_id, anchor AS window_start_us, count(*)::BIGINT AS matches, max(count)::BIGINT AS max_count
FROM cnt GROUP BY name, tenant_id, anchor""",

    "search_one": BASE + """
SELECT log_id, tenant_id, service, level, message, event_us, ingest_us FROM dd
WHERE tenant_id = 'tenant-0' AND service = 'error' AND level = 'ERROR'
  AND event_us >= epoch_us(TIMESTAMPTZ '2024-01-01 00:00:00+00') AND event_us <= epoch_us(TIMESTAMPTZ '2024-01-31 00:00:00+00')
ORDER BY event_us DESC, ingest_us DESC, log_id, service, level, message, host
LIMIT 100 OFFSET 0""",

    "search_cold": BASE + """
SELECT log_id, tenant_id, service, level, message, event_us, ingest_us FROM dd
WHERE tenant_id = 'tenant-0' AND service = 'error' AND level = 'ERROR'
  AND event_us >= epoch_us(TIMESTAMPTZ '2024-01-01 00:00:00+00') AND event_us <= epoch_us(TIMESTAMPTZ '2024-01-31 00:00:00+00')
ORDER BY event_us DESC, ingest_us DESC, log_id, service, level, message, host
LIMIT 100 OFFSET 0""",

    "search_hot": BASE + """
SELECT log_id, tenant_id, service, level, message, event_us, ingest_us FROM (
  SELECT * FROM dd
  QUALIFY log_id = '' OR row_number() OVER (
    PARTITION BY tenant_id, CAST(make_timestamp(event_us) AS DATE), log_id
    ORDER BY ingest_us DESC, log_id DESC, shift DESC) = 1)
WHERE tenant_id = 'tenant-0' AND service = 'error' AND level = 'ERROR'
  AND event_us >= epoch_us(TIMESTAMPTZ '2024-01-01 00:00:00+00') AND event_us <= epoch_us(TIMESTAMPTZ '2024-01-31 00:00:00+00')
ORDER BY event_us DESC, ingest_us DESC, log_id, service, level, message, host
LIMIT 100 OFFSET 0""",

    "route_tier": BASE + "," + REQUESTS + """
SELECT request_id, from_us, to_us, page_no, size, tier FROM routed2""",

    "search_pages": BASE + "," + REQUESTS + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY request_id
      ORDER BY event_us DESC, ingest_us DESC, log_id, service, level, message, host) AS rank FROM hits)
SELECT request_id, rank::BIGINT AS rank, log_id, event_us, ingest_us FROM ranked
WHERE rank > (page_no - 1) * size AND rank <= page_no * size""",

    "search_totals": BASE + "," + REQUESTS + """
SELECT r.request_id, r.page_no, r.size, r.tier, count(h.request_id)::BIGINT AS total
FROM routed2 r LEFT JOIN hits h ON h.request_id = r.request_id
GROUP BY r.request_id, r.page_no, r.size, r.tier""",

    "upsert_hot": BASE + """
SELECT tenant_id, strftime(CAST(make_timestamp(event_us) AS DATE), '%Y-%m-%d') AS event_date, log_id, ingest_us,
       shift, event_id
FROM nv
QUALIFY log_id = '' OR row_number() OVER (
  PARTITION BY tenant_id, CAST(make_timestamp(event_us) AS DATE), log_id
  ORDER BY ingest_us DESC, log_id DESC, shift DESC) = 1""",

    "route_keys": BASE + f"""
SELECT log_id, shift, event_id, tenant_id || '|' || service AS partition_key,
  'logs-' || tenant_id || '-' || strftime(make_timestamp(event_us), '%Y-%m-%d') AS index_name,
  tenant_id || '/2024/02/01/10/part-{cat.ARCHIVE_PART:05d}.gz' AS archive_path
FROM dd""",

    "parse_lines": "WITH " + LINES + """
SELECT doc_id, pos, log_id, level, message, event_us FROM ple""",

    "assemble_batches": "WITH " + LINES + f"""
SELECT agent_id, (rn0 // {cat.BATCH_SIZE})::BIGINT AS batch_no, count(*)::BIGINT AS n_entries,
  arg_min(log_id, rn0) AS first_log_id, arg_max(log_id, rn0) AS last_log_id
FROM ab GROUP BY agent_id, rn0 // {cat.BATCH_SIZE}""",

    "stamp_ingest": "WITH " + LINES + f"""
SELECT agent_id, (rn0 // {cat.BATCH_SIZE})::BIGINT AS batch_no,
  'tenant-' || (doc_id % 4)::VARCHAR || '|docs' AS key, (rn0 % {cat.BATCH_SIZE})::BIGINT AS position, log_id,
  'tenant-' || (doc_id % 4)::VARCHAR AS tenant_id, epoch_us(TIMESTAMPTZ '2024-03-01 00:00:00+00') AS ingest_us
FROM ab""",

    "decode_batches": "WITH " + DECODED + """
SELECT batch_id, position, agent_id, log_id, tenant_id, service, level, message, event_us, ingest_us FROM dec""",

    "dead_letter": "WITH " + DECODED + f""",
{DEAD}
SELECT reason_kind, payload FROM dead""",

    "authorize": """
WITH reqs AS (
  SELECT 'r' || event_id::VARCHAR AS request_id, 'tenant-' || (user_id % 4)::VARCHAR AS tenant_id,
    CASE WHEN event_id % 10 = 0 THEN 'wrong' ELSE 'k' || (user_id % 4)::VARCHAR END AS api_key
  FROM events),
keys(tenant_id, api_key) AS (VALUES """ + ", ".join(f"({_q(t)}, {_q(k)})" for t, k in fx.API_KEYS) + """)
SELECT request_id, tenant_id FROM reqs r
WHERE tenant_id <> '' AND EXISTS (SELECT 1 FROM keys k WHERE k.tenant_id = r.tenant_id AND k.api_key = r.api_key)""",
}

ORACLES["authorize_rejected"] = """
WITH reqs AS (
  SELECT 'r' || event_id::VARCHAR AS request_id, 'tenant-' || (user_id % 4)::VARCHAR AS tenant_id,
    CASE WHEN event_id % 10 = 0 THEN 'wrong' ELSE 'k' || (user_id % 4)::VARCHAR END AS api_key
  FROM events),
keys(tenant_id, api_key) AS (VALUES """ + ", ".join(f"({_q(t)}, {_q(k)})" for t, k in fx.API_KEYS) + """)
SELECT request_id, tenant_id, api_key FROM reqs r
WHERE NOT (tenant_id <> '' AND EXISTS (SELECT 1 FROM keys k WHERE k.tenant_id = r.tenant_id AND k.api_key = r.api_key))"""

_RPS = f"{float(cat.THROTTLE_RPS)}::DOUBLE"
_REFILL = (f"least(b.tokens + ((((q.ts_us - b.ts_us) * 1000) // 1000000000)::DOUBLE "
           f"+ (((q.ts_us - b.ts_us) * 1000) % 1000000000)::DOUBLE / 1e9) * {_RPS}, {_RPS})")
ORACLES["throttle"] = f"""
WITH RECURSIVE rq AS (
  SELECT 'r' || event_id::VARCHAR AS request_id, 'tenant-' || (user_id % 4)::VARCHAR AS tenant_id,
    event_id * 20000 AS ts_us,
    row_number() OVER (PARTITION BY 'tenant-' || (user_id % 4)::VARCHAR ORDER BY event_id * 20000, 'r' || event_id::VARCHAR) AS rn
  FROM events),
b(tenant_id, rn, ts_us, tokens, admitted) AS (
  SELECT tenant_id, rn, ts_us, (CASE WHEN {_RPS} >= 1 THEN {_RPS} - 1 ELSE {_RPS} END)::DOUBLE,
         CASE WHEN {_RPS} >= 1 THEN 1 ELSE 0 END FROM rq WHERE rn = 1
  UNION ALL
  SELECT q.tenant_id, q.rn, q.ts_us,
    CASE WHEN {_REFILL} >= 1 THEN {_REFILL} - 1 ELSE {_REFILL} END,
    CASE WHEN {_REFILL} >= 1 THEN 1 ELSE 0 END
  FROM b JOIN rq q ON q.tenant_id = b.tenant_id AND q.rn = b.rn + 1)
SELECT rq.request_id, rq.tenant_id, b.admitted::INTEGER AS admitted FROM b JOIN rq USING (tenant_id, rn)"""

_GAP = cat.SESSION_GAP_S * US
ORACLES["session_counter"] = BASE + f""",
s AS (
  SELECT tenant_id, service, ingest_us,
    CASE WHEN lag(ingest_us) OVER w IS NULL OR ingest_us - lag(ingest_us) OVER w > {_GAP} THEN 1 ELSE 0 END AS st
  FROM dd WINDOW w AS (PARTITION BY tenant_id, service ORDER BY ingest_us)),
s2 AS (SELECT *, sum(st) OVER (PARTITION BY tenant_id, service ORDER BY ingest_us, st DESC
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM s)
SELECT tenant_id, service, min(ingest_us) AS session_start_us, max(ingest_us) + {_GAP} AS session_end_us,
  count(*)::BIGINT AS count
FROM s2 GROUP BY tenant_id, service, sid"""

ORACLES["running_counter"] = BASE + f""",
s AS (
  SELECT *,
    CASE WHEN lag(ingest_us) OVER w IS NULL OR ingest_us - lag(ingest_us) OVER w > {_GAP} THEN 1 ELSE 0 END AS st
  FROM dd WINDOW w AS (PARTITION BY tenant_id, service ORDER BY ingest_us, log_id, shift)),
s2 AS (SELECT *, sum(st) OVER (PARTITION BY tenant_id, service ORDER BY ingest_us, log_id, shift
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM s)
SELECT tenant_id, service, log_id, shift, ingest_us,
  row_number() OVER (PARTITION BY tenant_id, service, sid ORDER BY ingest_us, log_id, shift)::BIGINT AS counter,
  min(ingest_us) OVER (PARTITION BY tenant_id, service, sid) AS session_start_us
FROM s2"""

SUBS = ", ".join(f"({_q(a)}, {_q(b)}, {_q(c)}, upper({_q(d)}))" for a, b, c, d in fx.SUBSCRIPTIONS)
ORACLES["tail_fanout"] = BASE + f""",
subs(subscriber_id, s_tenant, s_service, s_level) AS (VALUES {SUBS}),
j AS (
  SELECT s.*, d.*, row_number() OVER (PARTITION BY s.subscriber_id, d.ingest_us // 60000000
      ORDER BY d.ingest_us, d.log_id, d.shift) AS slot
  FROM dd d JOIN subs s ON d.tenant_id = s.s_tenant)
SELECT subscriber_id, log_id, tenant_id, service, level, shift FROM j
WHERE slot <= {cat.TAIL_CAP} AND (s_service = '' OR service = s_service) AND (s_level = '' OR level = s_level)"""

# one entry as JSON text: key order of the record, empty optional strings left out, times as
# RFC 3339 with trimmed fraction, the fields map last
TAIL_ENTRY_JSON = ("'{\"log_id\":' || to_json(log_id) || ',\"tenant_id\":' || to_json(tenant_id) || "
                   "',\"service\":' || to_json(service) || ',\"host\":' || to_json(host) || "
                   "',\"environment\":' || to_json('test') || ',\"level\":' || to_json(level) || "
                   "',\"message\":' || to_json(message) || ',\"event_timestamp\":' || " + _ts_json("event_us") +
                   " || ',\"ingest_timestamp\":' || " + _ts_json("ingest_us") +
                   " || ',\"fields\":{\"k\":' || to_json(k) || '}}'")
ORACLES["tail_frames"] = BASE + f""",
subs(subscriber_id, s_tenant, s_service, s_level) AS (VALUES {SUBS}),
j AS (
  SELECT s.*, d.*, row_number() OVER (PARTITION BY s.subscriber_id, d.ingest_us // 60000000
      ORDER BY d.ingest_us, d.log_id, d.shift) AS slot
  FROM dd d JOIN subs s ON d.tenant_id = s.s_tenant)
SELECT subscriber_id, log_id, shift, ('data: ' || {TAIL_ENTRY_JSON} || chr(10) || chr(10))::VARCHAR AS frame FROM j
WHERE slot <= {cat.TAIL_CAP} AND (s_service = '' OR service = s_service) AND (s_level = '' OR level = s_level)"""

ORACLES["archive_roundtrip"] = BASE + """
SELECT log_id, tenant_id, service, level, message, event_us, ingest_us,
  epoch_us(TIMESTAMPTZ '2024-02-01 10:00:00+00') AS archived_hour_us
FROM dd"""

ORACLES["log_pipeline"] = "WITH " + DECODED + f""",
edges(batch_id) AS (VALUES {", ".join("(" + _q(i) + ")" for i in _EDGE_BAD)}),
valid AS (SELECT * FROM dec WHERE tenant_id <> '' AND message <> '')
SELECT 'normalized' AS output, tenant_id || '|' || service AS detail, count(*)::BIGINT AS n FROM valid GROUP BY 1, 2
UNION ALL
SELECT 'dead_letter', 'unmarshal error', count(*)::BIGINT FROM edges
UNION ALL
SELECT 'dead_letter', 'normalise failed', count(*)::BIGINT FROM dec WHERE NOT (tenant_id <> '' AND message <> '')"""

ORACLES["hot_generations"] = BASE + """,
gens AS (SELECT *, 0 AS gen FROM nv WHERE shift < 300 UNION ALL SELECT *, 1 FROM nv WHERE shift >= 300 OR event_id % 5 = 0)
SELECT tenant_id, strftime(CAST(make_timestamp(event_us) AS DATE), '%Y-%m-%d') AS event_date, log_id, message, event_us, ingest_us
FROM gens
QUALIFY log_id = '' OR row_number() OVER (
  PARTITION BY tenant_id, CAST(make_timestamp(event_us) AS DATE), log_id ORDER BY gen DESC, ingest_us DESC) = 1"""

ORACLES["match_many"] = BASE + """,
many AS (
  SELECT 'o' || o_orderkey::VARCHAR AS rule,
    CASE WHEN o_orderkey % 5 = 0 THEN '*' ELSE 'tenant-' || (o_custkey % 4)::VARCHAR END AS rtenant,
    CASE o_orderkey % 3 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'INFO' ELSE '' END AS rlevel,
    ' k=' || o_orderkey::VARCHAR AS needle
  FROM orders),
msgs AS (SELECT DISTINCT tenant_id, level, message FROM nv),
hit AS (
  SELECT m.*, r.rule FROM msgs m JOIN many r
    ON (r.rtenant = '*' OR r.rtenant = m.tenant_id) AND (r.rlevel = '' OR r.rlevel = m.level) AND contains(lower(m.message), r.needle))
SELECT h.rule, n.log_id, n.shift, n.event_id FROM nv n JOIN hit h
  ON h.tenant_id = n.tenant_id AND h.level = n.level AND h.message = n.message"""

# in millionths of a token: every request refills what the time since the last one brings, cut to a full bucket
_FULL = cat.THROTTLE_RPS * 1_000_000
_STEP = f"least(b.left_ + (q.ts_us - b.ts_us) * {cat.THROTTLE_RPS}, {_FULL})"
ORACLES["throttle_overload"] = f"""
WITH RECURSIVE rq AS (SELECT event_id, event_id * 20000 AS ts_us, row_number() OVER (ORDER BY event_id * 20000, event_id) AS rn FROM events),
b(rn, event_id, ts_us, left_, admitted) AS (
  SELECT rn, event_id, ts_us, {_FULL} - 1000000, 1 FROM rq WHERE rn = 1
  UNION ALL
  SELECT q.rn, q.event_id, q.ts_us, CASE WHEN {_STEP} >= 1000000 THEN {_STEP} - 1000000 ELSE {_STEP} END,
    CASE WHEN {_STEP} >= 1000000 THEN 1 ELSE 0 END
  FROM b JOIN rq q ON q.rn = b.rn + 1)
SELECT 'r' || event_id::VARCHAR AS request_id, admitted::INTEGER AS admitted, left_::BIGINT AS micro_tokens FROM b"""

ORACLES["dedup_batches"] = BASE + """
SELECT log_id, tenant_id, shift, event_id, ingest_us FROM dd"""

ORACLES["gateway"] = f"""
WITH RECURSIVE keys(tenant_id, api_key) AS (VALUES {", ".join(f"({_q(t)}, {_q(k)})" for t, k in fx.API_KEYS)}),
rq0 AS (
  SELECT event_id, event_type, 'r' || event_id::VARCHAR AS request_id, 'tenant-' || (user_id % 4)::VARCHAR AS tenant_id,
    event_id * 20000 AS ts_us, CASE WHEN event_id % 10 = 0 THEN 'wrong' ELSE 'k' || (user_id % 4)::VARCHAR END AS api_key
  FROM events),
rq AS (
  SELECT r.*, row_number() OVER (PARTITION BY r.tenant_id ORDER BY ts_us, request_id) AS rn
  FROM rq0 r JOIN keys k ON k.tenant_id = r.tenant_id AND k.api_key = r.api_key),
b(tenant_id, rn, ts_us, tokens, admitted) AS (
  SELECT tenant_id, rn, ts_us, ({_RPS} - 1)::DOUBLE, 1 FROM rq WHERE rn = 1
  UNION ALL
  SELECT q.tenant_id, q.rn, q.ts_us, CASE WHEN {_REFILL} >= 1 THEN {_REFILL} - 1 ELSE {_REFILL} END, CASE WHEN {_REFILL} >= 1 THEN 1 ELSE 0 END
  FROM b JOIN rq q ON q.tenant_id = b.tenant_id AND q.rn = b.rn + 1),
st AS (
  SELECT r.*, CASE WHEN b.rn IS NULL THEN 401 WHEN b.admitted = 0 THEN 429 WHEN r.event_id % 11 = 0 THEN 400 ELSE 202 END::INTEGER AS status
  FROM rq0 r LEFT JOIN rq q ON q.event_id = r.event_id LEFT JOIN b ON b.tenant_id = q.tenant_id AND b.rn = q.rn)
SELECT request_id, status, NULL::VARCHAR AS key, NULL::BIGINT AS position, NULL::VARCHAR AS log_id, tenant_id, NULL::BIGINT AS ingest_us
FROM st WHERE status <> 202
UNION ALL
SELECT request_id, status, tenant_id || '|' || event_type, position, 'e' || event_id::VARCHAR, tenant_id, ts_us
FROM (SELECT *, unnest(range(CASE WHEN event_id % 12 = 0 THEN 2 ELSE 1 END))::BIGINT AS position FROM st WHERE status = 202)"""

ORACLES["search_tiers"] = BASE + "," + REQUESTS + """,
lww AS (
  SELECT * FROM dd
  QUALIFY log_id = '' OR row_number() OVER (
    PARTITION BY tenant_id, CAST(make_timestamp(event_us) AS DATE), log_id ORDER BY ingest_us DESC, log_id DESC) = 1),
thits AS (
  SELECT h.*, r.tier FROM hits h JOIN routed2 r ON r.request_id = h.request_id
  WHERE r.tier = 'cold' OR EXISTS (SELECT 1 FROM lww l WHERE l.event_id = h.event_id AND l.shift = h.shift)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY request_id
      ORDER BY event_us DESC, ingest_us DESC, log_id, service, level, message, host) AS rank FROM thits)
SELECT request_id, tier, rank::BIGINT AS rank, log_id, event_us FROM ranked
WHERE rank > (page_no - 1) * size AND rank <= page_no * size"""

ORACLES["search_deep"] = BASE + """
SELECT log_id, service, event_us, ingest_us FROM (
  SELECT *, row_number() OVER (ORDER BY event_us DESC, ingest_us DESC, log_id, service, level, message, host) AS rn,
    count(*) OVER () AS n FROM dd WHERE tenant_id = 'tenant-1')
WHERE rn > n * 3 // 4 AND rn <= n * 3 // 4 + 100"""

ORACLES["cold_hours"] = BASE + f"""
SELECT log_id, tenant_id, service, event_us, ingest_us FROM dd
WHERE event_us BETWEEN epoch_us(TIMESTAMPTZ '{cat.COLD_HOURS[0].isoformat()}') AND epoch_us(TIMESTAMPTZ '{cat.COLD_HOURS[1].isoformat()}')"""

ORACLES["normalized"] = "WITH " + DECODED + f""",
{VALID}
SELECT key, value, time_us, row_number() OVER (PARTITION BY key ORDER BY time_us NULLS FIRST, value)::BIGINT AS position FROM bus"""

ORACLES["spool_replay"] = """
SELECT CASE WHEN (conv_id % 61) % 2 = 0 THEN 'plain' ELSE 'packed' END AS form,
  (row_number() OVER (PARTITION BY conv_id % 61 ORDER BY conv_id, turn) - 1)::BIGINT AS position, 'spool' AS agent_id,
  conv_id::VARCHAR || '-' || turn::VARCHAR AS log_id, 'tenant-' || (conv_id % 4)::VARCHAR AS tenant_id, role AS service, text AS message
FROM conversations"""

ORACLES["file_lines"] = "WITH " + LINES + """
SELECT message AS line, level FROM ple"""

ORACLES["stream_outputs"] = "WITH " + DECODED + f""",
{DEAD},
{VALID}
SELECT 'normalized' AS output, key, value FROM bus
UNION ALL SELECT 'dead_letter', reason_kind, payload FROM dead
UNION ALL SELECT 'hot', tenant_id, log_id FROM bus
UNION ALL SELECT 'cold', tenant_id, log_id FROM bus"""
