"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from driftlog.llm import mixing as mx

_WORD = r"[^\x20\x09-\x0D]+"


def _hash(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def _shuffle(name: str, rows: str, x: str, n: str, key: str, out: str) -> str:
    """CTEs that end in ``name``: ``rows`` with ``out``, the swap-or-not image of ``x`` in 0..n-1.

    Every round is materialized; inlined, each would repeat the one before it four times.
    """
    sql = f"{name}_0 AS MATERIALIZED (SELECT *, {x} AS {out} FROM ({rows}))"
    for r in range(mx.ROUNDS):
        other = f"((({_hash(f'{key} || $$:k:{r}$$')} - {out}) % {n}) + {n}) % {n}"
        bit = f"substr(md5({key} || $$:{r}:$$ || greatest({out}, other)), 1, 1) >= '8'"
        sql += f",\n{name}_{r}x AS MATERIALIZED (SELECT *, {other} AS other FROM {name}_{r})"
        sql += f",\n{name}_{r + 1} AS MATERIALIZED (SELECT * EXCLUDE (other) REPLACE (CASE WHEN {bit} THEN other ELSE {out} END AS {out}) FROM {name}_{r}x)"
    return f"{sql},\n{name} AS (SELECT * FROM {name}_{mx.ROUNDS})"


_B, _M = mx.BLOCK_WORDS, mx.MAX_REPEATS

_SLOTS = _shuffle("dealt_slots", "SELECT range AS slot, total FROM (SELECT sum(slots)::BIGINT AS total FROM t) t0, range(0, t0.total)", "slot", "total", f"'{mx.SEED}:slots'", "dealt")
_PLACED = """SELECT rank, n_blocks, (dealt - first_slot) % n_blocks AS k, (dealt - first_slot) // n_blocks AS pass
FROM dealt_slots s JOIN t ON t.slots > 0 AND s.dealt BETWEEN t.first_slot AND t.first_slot + t.slots - 1"""
_BLOCKS = _shuffle("dealt_blocks", _PLACED, "k", "n_blocks", f"('{mx.SEED}:' || rank || ':' || pass)", "block")

OP5 = f"""
WITH d AS MATERIALIZED (SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source COLLATE "binary" ASC NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, [{', '.join(map(str, mx.WEIGHTS))}][((rank - 1) % {len(mx.WEIGHTS)}) + 1] AS w FROM p),
o AS (SELECT *, (sum(s) OVER ())::BIGINT - {_M} * coalesce(sum(s) OVER (ORDER BY {_M} * s / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
  (sum(w) OVER (ORDER BY {_M} * s / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS ws FROM w),
l AS (SELECT rest AS lr, ws AS lw FROM o WHERE {_M} * s * ws > rest * w ORDER BY ws DESC LIMIT 1),
g AS (SELECT source, rank, s, CASE WHEN {_M} * s * ws > rest * w THEN least(({_M} * s)::DOUBLE, (lr * w)::DOUBLE / lw) ELSE ({_M} * s)::DOUBLE END AS target,
  ((s + {_B - 1}) // {_B}) AS n_blocks FROM o LEFT JOIN l ON true),
t0 AS (SELECT *, least(floor(target * n_blocks / greatest(s, 1) + 0.5), {_M} * n_blocks)::BIGINT AS slots FROM g),
t AS MATERIALIZED (SELECT *, coalesce(sum(slots) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_slot FROM t0),
{_SLOTS},
{_BLOCKS},
u AS (SELECT rank, block, count(*) AS times FROM dealt_blocks GROUP BY ALL),
b AS (SELECT d.doc_id, d.size, t.rank, t.s, t.target,
  coalesce(sum(d.size) OVER (PARTITION BY t.rank ORDER BY md5('{mx.SEED}:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || d.size), d.doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, unnest(range(start // {_B}, (start + size - 1) // {_B} + 1)) AS block FROM b WHERE size > 0)
SELECT x.doc_id, x.size, any_value(x.s) AS source_size, any_value(x.target) AS target,
  sum((least((x.block + 1) * {_B} - x.start, x.size) - greatest(x.block * {_B} - x.start, 0)) * coalesce(u.times, 0))::BIGINT AS taken
FROM x LEFT JOIN u USING (rank, block) GROUP BY x.rank, x.start, x.doc_id, x.size
UNION ALL SELECT doc_id, size, s, target, 0 FROM b WHERE size = 0
"""


def _op3() -> str:
    from driftlog.llm import urls as u

    rules = sorted(u.RULES, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in rules]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits) + " END"
    ruled = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits) + " END"
    fold = lambda x: f"translate({x}, '{u._UPPER}', '{u._LOWER}')"
    sql = f"""WITH a AS MATERIALIZED (SELECT page_id, html, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS MATERIALIZED (SELECT page_id, html, {fold("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
j AS MATERIALIZED (SELECT page_id, host, path, {rule} AS rule, {ruled} AS ruled FROM h),
f AS (SELECT host AS src, unnest(regexp_extract_all(html, $x${u.LINK}$x$, 1)) AS dst0 FROM h),
l AS MATERIALIZED (SELECT src, {fold('dst0')} AS dst, count(*) AS n FROM f WHERE src <> '' AND src <> {fold('dst0')} GROUP BY ALL),
s AS (SELECT DISTINCT host FROM (SELECT host FROM h UNION ALL SELECT dst FROM l) WHERE host <> ''),
n AS MATERIALIZED (SELECT DISTINCT unnest(CASE WHEN contains(host, '.') THEN list_transform(range(1, len(string_split(host, '.')) + 1), lambda k: array_to_string(string_split(host, '.')[k:], '.')) ELSE [host] END) AS host FROM s),
p AS (SELECT host AS src, regexp_extract(host, '^[^.]*\\.(.*)$', 1) AS dst FROM n WHERE contains(regexp_extract(host, '^[^.]*\\.(.*)$', 1), '.')),
e AS MATERIALIZED (SELECT src, dst, sum(n)::BIGINT AS n FROM (SELECT * FROM l UNION ALL SELECT src, dst, 1 FROM p UNION ALL SELECT dst, src, 1 FROM p) GROUP BY ALL),
b AS (SELECT 0 AS kind, src, dst, n FROM e UNION ALL SELECT 1, dst, src, n FROM e),
sh AS MATERIALIZED (SELECT kind, src, dst, n, (sum(n) OVER (PARTITION BY kind, src))::HUGEINT AS out FROM b),
sd AS (SELECT CASE WHEN ruled = 'allow' THEN 0 ELSE 1 END AS kind, host, count(*) AS n FROM j WHERE ruled IS NOT NULL AND host <> '' GROUP BY ALL),
r0 AS MATERIALIZED (SELECT kind, host, ('{u.MASS}'::HUGEINT * n) // (sum(n) OVER (PARTITION BY kind))::HUGEINT AS mass FROM sd),
re AS MATERIALIZED (SELECT kind, host, (mass * {100 - u.DAMPING}) // 100 AS mass FROM r0)"""
    for k in range(1, u.STEPS + 1):
        sql += f""",
r{k} AS MATERIALIZED (SELECT kind, host, sum(mass)::HUGEINT AS mass FROM (SELECT sh.kind, dst AS host, ((mass * n // out) * {u.DAMPING}) // 100 AS mass
  FROM r{k - 1} r JOIN sh ON r.kind = sh.kind AND r.host = sh.src UNION ALL SELECT * FROM re) GROUP BY ALL)"""
    step = u.MASS // u.REPORTED
    return f"""{sql},
sc AS (SELECT host, coalesce(sum(mass) FILTER (kind = 0), 0)::HUGEINT AS trust, coalesce(sum(mass) FILTER (kind = 1), 0)::HUGEINT AS distrust FROM r{u.STEPS} GROUP BY host)
SELECT page_id, j.host, path, rule, coalesce(ruled, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict,
  ((coalesce(trust, 0) + {step - 1}) // {step})::BIGINT AS trust, ((coalesce(distrust, 0) + {step - 1}) // {step})::BIGINT AS distrust FROM j LEFT JOIN sc ON j.host = sc.host"""


OP3 = _op3()
ORACLES = {"op3_url_filters": OP3, "op5_mixing": OP5}
