"""Search: filtered, time-bounded, full-text search with an exact total and stable paging.

A request is tenant equality + an inclusive event-time range (bounds floored to
the second), plus service, level and text filters when they are non-empty.
Results are sorted by event time desc, ingest time desc, then id and content so
the order is total and pages never overlap.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from driftlog.functions.text import query_terms, text_match, tokens
from driftlog.functions.timefmt import floor_second, parse_rfc3339
from driftlog.operators.paging import page_at
from driftlog.session import ensure_checkpoint_dir

# Fixed values (must equal the reference): paging defaults and limits.
DEFAULT_PAGE_SIZE = 100
MAX_PAGE_SIZE = 1000
DEFAULT_SPAN = timedelta(hours=1)
DEFAULT_HOT_DAYS = 30

# Rows before and in a page that one top-k holds, at most; deeper pages are selected by key range.
DEEP_ROWS = 100_000

# Request batches are broadcast only up to this many rows; beyond, a shuffle join.
MAX_BROADCAST_REQUESTS = 100_000

_INT_RE = re.compile(r"^[+-]?[0-9]+$")
_RFC3339 = re.compile(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$")


def _parse_time(text: str | None) -> datetime | None:
    if not text or not _RFC3339.match(text):
        return None
    body = text.replace("Z", "+00:00")
    m = re.match(r"^(.*?T\d{2}:\d{2}:\d{2})(\.\d+)?(.*)$", body)
    frac = (m.group(2) or "")[:7].ljust(7, "0") if m.group(2) else ""
    try:
        ts = datetime.fromisoformat(m.group(1) + (frac if frac else "") + m.group(3))
    except ValueError:
        return None
    ts = ts.astimezone(timezone.utc)
    if ts == datetime(1, 1, 1, tzinfo=timezone.utc):
        return None
    return ts


def _parse_int(text: str | None) -> int | None:
    if text is None or not _INT_RE.match(text):
        return None
    v = int(text)
    return v if -(2**63) <= v < 2**63 else None


@dataclass
class SearchRequest:
    tenant_id: str
    service: str = ""
    level: str = ""
    q: str = ""
    from_ts: datetime | None = None
    to_ts: datetime | None = None
    page: int = 1
    page_size: int = DEFAULT_PAGE_SIZE
    terms: list[str] = field(default_factory=list)

    @classmethod
    def parse(cls, tenant_id: str, params: dict[str, str], now: datetime) -> "SearchRequest":
        """Defaults as the service applies them: bad/absent 'to' -> now, bad/absent
        'from' -> to - 1 h, page > 0 else 1, page_size in 1..1000 else 100."""
        to = _parse_time(params.get("to")) or now.astimezone(timezone.utc)
        frm = _parse_time(params.get("from")) or (to - DEFAULT_SPAN)
        page = _parse_int(params.get("page"))
        page = page if page is not None and page > 0 else 1
        size = _parse_int(params.get("page_size"))
        size = size if size is not None and 0 < size <= MAX_PAGE_SIZE else DEFAULT_PAGE_SIZE
        q = params.get("q", "") or ""
        return cls(tenant_id, params.get("service", "") or "", params.get("level", "") or "", q,
                   frm, to, page, size, query_terms(q))

    def tier(self, now: datetime, hot_days: int = DEFAULT_HOT_DAYS) -> str:
        """'hot' iff from is strictly after now - hot_days (the whole request goes to one tier)."""
        return "hot" if self.from_ts > now - timedelta(days=hot_days) else "cold"


def _floor_s(ts: datetime) -> datetime:
    return ts.replace(microsecond=0)


def order_columns() -> list[Column]:
    """Event time desc, ingest time desc, then id and all other columns: rows that still tie are equal."""
    return [F.col("event_timestamp").desc(), F.col("ingest_timestamp").desc(), F.col("log_id").asc(),
            F.col("service").asc(), F.col("level").asc(), F.col("message").asc(), F.col("host").asc(),
            F.col("container").asc(), F.col("environment").asc(), F.col("trace_id").asc(), F.col("request_id").asc(),
            F.to_json("fields").asc()]


def request_predicate(req: SearchRequest, has_date: bool = True, has_terms: bool = False) -> Column:
    """Literal filter: reaches the Parquet scan and prunes (tenant_id, event_date) partitions."""
    lo, hi = _floor_s(req.from_ts), _floor_s(req.to_ts)
    pred = (F.col("tenant_id") == F.lit(req.tenant_id)) & (F.col("event_timestamp") >= F.lit(lo)) & (
        F.col("event_timestamp") <= F.lit(hi))
    if has_date:
        # the day-partition predicate derived from the range (partition pruning)
        pred = pred & F.col("event_date").between(F.lit(lo.date()), F.lit(hi.date()))
    if req.service:
        pred = pred & (F.col("service") == F.lit(req.service))
    if req.level:
        pred = pred & (F.col("level") == F.lit(req.level))
    if req.q:
        terms = F.col("message_terms") if has_terms else tokens(F.col("message"))
        pred = pred & text_match(terms, req.terms)
    return pred


def search(table: DataFrame, req: SearchRequest) -> tuple[DataFrame, Observation]:
    """(page, observation): the page DataFrame plans as one top-k (TakeOrderedAndProject)
    and the exact total is observed in the same scan; read ``obs.get["total"]`` after
    an action on the page."""
    obs = Observation(f"search-{uuid.uuid4().hex}")
    has_date = "event_date" in table.columns
    has_terms = "message_terms" in table.columns
    offset = (req.page - 1) * req.page_size
    found = table.filter(request_predicate(req, has_date, has_terms))
    if offset + req.page_size > DEEP_ROWS:
        # a top-k would hold all rows before the page: the part of the time range that holds it is found first
        keys = [F.unix_micros("event_timestamp"), F.unix_micros("ingest_timestamp")]
        return page_at(found, keys, order_columns(), offset, req.page_size), _CountedTotal(found)
    filtered = found.observe(obs, F.count(F.lit(1)).alias("total"))
    page = filtered.orderBy(*order_columns()).offset(offset).limit(req.page_size)
    return page, obs


class _CountedTotal:
    """Observation stand-in for deep pages: ``get`` counts the matches."""

    def __init__(self, df: DataFrame):
        self._df = df

    @property
    def get(self) -> dict:
        return {"total": self._df.count()}


def run_search(table: DataFrame, req: SearchRequest) -> dict:
    """Execute one request: {'total', 'page', 'page_size', 'entries'} (entries are at most one page)."""
    page_df, obs = search(table, req)
    rows = [r.asDict(recursive=True) for r in page_df.collect()]
    total = obs.get.get("total", 0)
    return {"total": int(total), "page": req.page, "page_size": req.page_size, "entries": rows}


def route_tier(requests: DataFrame, now: datetime, hot_days: int = DEFAULT_HOT_DAYS) -> DataFrame:
    """Batch form of the request defaults and routing for a table of raw (string) requests.

    Adds from_ts, to_ts (effective bounds), page_no, size, tier, lo_ts, hi_ts (floored bounds).
    """
    now_l = F.lit(now.astimezone(timezone.utc))
    to = F.coalesce(parse_rfc3339(F.col("to")), now_l)
    frm = F.coalesce(parse_rfc3339(F.col("from")), to - F.expr("INTERVAL 1 HOUR"))
    page = F.when(F.col("page").rlike("^[+-]?[0-9]+$"), F.expr("try_cast(page AS BIGINT)"))
    size = F.when(F.col("page_size").rlike("^[+-]?[0-9]+$"), F.expr("try_cast(page_size AS BIGINT)"))
    cutoff = now_l - F.make_interval(days=F.lit(hot_days))
    return (
        requests.withColumn("to_ts", to)
        .withColumn("from_ts", frm)
        .withColumn("page_no", F.when(page > 0, page).otherwise(F.lit(1)).cast("long"))
        .withColumn("size", F.when((size > 0) & (size <= MAX_PAGE_SIZE), size)
                    .otherwise(F.lit(DEFAULT_PAGE_SIZE)).cast("long"))
        .withColumn("tier", F.when(F.col("from_ts") > cutoff, F.lit("hot")).otherwise(F.lit("cold")))
        .withColumn("lo_ts", floor_second(F.col("from_ts")))
        .withColumn("hi_ts", floor_second(F.col("to_ts")))
    )


def search_tiers(hot: DataFrame, cold: DataFrame, routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``search_many`` with each request against the tier it is routed to (the whole request goes to one)."""
    routed = _settled(routed)
    (hot_page, hot_total), (cold_page, cold_total) = (
        _search_many(table, routed.where(F.col("tier") == tier)) for table, tier in ((hot, "hot"), (cold, "cold")))
    shared = [c for c in cold_page.columns if c in hot_page.columns]  # each tier keeps what it prunes by
    label = lambda page, tier: page.select(*shared, F.lit(tier).alias("tier"))
    return label(hot_page, "hot").unionByName(label(cold_page, "cold")), hot_total.unionByName(cold_total)


def search_many(table: DataFrame, routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Answer a batch of routed requests at once: (page rows, totals per request), keyed by
    ``search_id`` (the request's ``request_id``; entries have a column of that name).

    Each request is expanded into the UTC days its range covers (the day
    partitions it would read) and joins the entries on (tenant, day) by hash,
    with the exact range, service, level and text filters as residuals, so
    no request is paired with a tenant's whole history. A constant bound on
    the deepest page lets each task keep only its per-request top-k before the
    shuffle (window group limit); the total is a count per request.
    """
    return _search_many(table, _settled(routed))


def _settled(routed: DataFrame) -> DataFrame:
    """The requests, made once: a filter on what is parsed from them would otherwise be pushed below whatever they
    are derived by, and parse there for every row of their source, in each plan that reads them."""
    ensure_checkpoint_dir(routed.sparkSession)
    return routed.checkpoint(eager=True)


def _search_many(table: DataFrame, routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    day = F.col("event_date") if "event_date" in table.columns else F.to_date(F.col("event_timestamp"))
    # terms are made once for each entry, not for each pair of an entry and a request
    terms = F.col("message_terms") if "message_terms" in table.columns else tokens(F.col("message"))
    entries, terms = table.withColumn("__terms", terms), F.col("__terms")
    r = routed.select(
        F.col("request_id").alias("search_id"), F.col("tenant_id").alias("r_tenant"),
        F.col("service").alias("r_service"), F.col("level").alias("r_level"),
        F.coalesce(F.col("q"), F.lit("")).alias("r_q"), tokens(F.coalesce(F.col("q"), F.lit(""))).alias("r_terms"),
        "lo_ts", "hi_ts", "page_no", "size",
    ).filter(F.col("lo_ts") <= F.col("hi_ts"))
    r = r.withColumn("r_day", F.explode(F.sequence(F.to_date("lo_ts"), F.to_date("hi_ts"))))
    # one small job: the size check before any broadcast, and the deepest row any request needs
    # try_multiply: a page past the 64-bit range has no rows (it must not fail the batch)
    deepest = F.try_multiply(F.col("page_no"), F.col("size"))
    stats = r.agg(F.count(F.lit(1)).alias("n"), F.max(deepest).alias("k")).first()
    small = stats["n"] <= MAX_BROADCAST_REQUESTS
    kmax = stats["k"] or 0
    if small:
        r = F.broadcast(r)
    cond = (
        (F.col("tenant_id") == F.col("r_tenant")) & (day == F.col("r_day"))
        & (F.col("event_timestamp") >= F.col("lo_ts")) & (F.col("event_timestamp") <= F.col("hi_ts"))
        & ((F.col("r_service") == "") | (F.col("service") == F.col("r_service")))
        & ((F.col("r_level") == "") | (F.col("level") == F.col("r_level")))
        & ((F.col("r_q") == "") | F.arrays_overlap(terms, F.col("r_terms")))
    )
    hits = entries.join(r, cond, "inner").drop("__terms")
    # a constant bound on the rank enables the map-side top-k (WindowGroupLimit)
    w = Window.partitionBy("search_id").orderBy(*order_columns())
    ranked = hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.lit(int(kmax)))
    ranked = ranked.withColumn("rank", F.col("rank").cast("long"))
    lo = F.try_multiply(F.col("page_no") - 1, F.col("size"))
    page = ranked.filter(lo.isNotNull() & (F.col("rank") > lo) & (F.col("rank") - F.col("size") <= lo))
    counts = hits.groupBy("search_id").agg(F.count(F.lit(1)).alias("total"))
    counts = F.broadcast(counts) if small else counts  # one row per request at most
    totals = routed.select(F.col("request_id").alias("search_id"), "page_no", "size", "tier") \
        .join(counts, "search_id", "left") \
        .withColumn("total", F.coalesce(F.col("total"), F.lit(0)).cast("long"))
    return page, totals
