from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from driftlog import fixtures as fx
from driftlog.operators.search import SearchRequest, route_tier, run_search, search, search_many
from driftlog.sources.hot import read_hot, upsert_hot
from driftlog.plans.catalog import deduped_entries
from driftlog.schemas import LOG_ENTRY
from tests.conftest import SF001
from tests.helpers import at, entry

NOW = datetime(2024, 1, 30, tzinfo=timezone.utc)


def test_request_defaults():
    r = SearchRequest.parse("t", {}, NOW)
    assert r.to_ts == NOW and (r.to_ts - r.from_ts).total_seconds() == 3600 and r.page == 1 and r.page_size == 100
    r = SearchRequest.parse("t", {"page": "0", "page_size": "1001", "to": "2024-01-02T00:00:00Z"}, NOW)
    assert r.page == 1 and r.page_size == 100 and r.to_ts.day == 2
    r = SearchRequest.parse("t", {"page": "3", "page_size": "1000", "from": "bad"}, NOW)
    assert (r.page, r.page_size) == (3, 1000) and (r.to_ts - r.from_ts).total_seconds() == 3600
    r = SearchRequest.parse("t", {"page": "abc", "page_size": "-5", "from": "2024-01-05T10:00:00.9+01:00"}, NOW)
    assert (r.page, r.page_size) == (1, 100) and r.from_ts.hour == 9


def test_tier_routing():
    r = SearchRequest.parse("t", {"from": "2023-12-31T00:00:00Z"}, NOW)
    assert r.tier(NOW, 30) == "cold"  # exactly at the cutoff is not strictly after it
    r = SearchRequest.parse("t", {"from": "2023-12-31T00:00:01Z"}, NOW)
    assert r.tier(NOW, 30) == "hot"


def test_route_tier_batch_matches_driver_side(spark):
    routed = route_tier(fx.search_requests(spark), NOW).collect()
    for row in routed:
        req = SearchRequest.parse(row.tenant_id, {k: row[k] for k in ("from", "to", "page", "page_size")}, NOW)
        assert (row.page_no, row.size, row.tier) == (req.page, req.page_size, req.tier(NOW))
        naive = lambda d: d.astimezone(timezone.utc).replace(tzinfo=None)
        assert row.from_ts == naive(req.from_ts) and row.to_ts == naive(req.to_ts)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hot") / "hot")
    upsert_hot(deduped_entries(spark, SF001), path)
    return read_hot(spark, path)


def test_paging_is_stable_and_total_exact(spark, hot):
    base = {"from": "2024-01-01T00:00:00Z", "to": "2024-01-31T00:00:00Z", "page_size": "7"}
    pages = [run_search(hot, SearchRequest.parse("tenant-1", {**base, "page": str(p)}, NOW)) for p in (1, 2, 3)]
    ids = [e["log_id"] + str(e["ingest_timestamp"]) for p in pages for e in p["entries"]]
    assert len(ids) == 21 and len(set(ids)) == 21
    total = hot.filter("tenant_id = 'tenant-1'").filter(
        F.col("event_timestamp").between(datetime(2024, 1, 1), datetime(2024, 1, 31))).count()
    assert all(p["total"] == total for p in pages)
    evs = [e["event_timestamp"] for p in pages for e in p["entries"]]
    assert evs == sorted(evs, reverse=True)


def test_page_past_the_end(spark, hot):
    res = run_search(hot, SearchRequest.parse("tenant-0", {"from": "2024-01-01T00:00:00Z",
                                                           "to": "2024-01-31T00:00:00Z", "page": "999"}, NOW))
    assert res["entries"] == [] and res["total"] > 0


def test_text_and_bounds(spark, hot):
    req = SearchRequest.parse("tenant-2", {"q": "K=7 nothing", "from": "2024-01-01T00:00:00Z",
                                           "to": "2024-01-31T00:00:00Z", "page_size": "1000"}, NOW)
    res = run_search(hot, req)
    assert res["total"] > 0 and all("7" in e["message"].split("=")[-1].split() or "k" in e["message"]
                                    for e in res["entries"])
    # from > to: empty
    req = SearchRequest.parse("tenant-2", {"from": "2024-01-20T00:00:00Z", "to": "2024-01-10T00:00:00Z"}, NOW)
    assert run_search(hot, req)["total"] == 0


def test_plan_prunes_partitions_and_uses_top_k(spark, hot):
    req = SearchRequest.parse("tenant-1", {"level": "ERROR", "from": "2024-01-03T00:00:00Z",
                                           "to": "2024-01-04T00:00:00Z", "page": "2", "page_size": "10"}, NOW)
    page, _ = search(hot, req)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "PartitionFilters: [isnotnull(tenant_id" in plan and "event_date" in plan.split("PartitionFilters")[1]
    assert "PushedFilters" in plan and "level" in plan.split("PushedFilters")[1]


def test_search_many_matches_single_searches(spark, hot):
    reqs = fx.search_requests(spark)
    page, totals = search_many(hot, route_tier(reqs, NOW))
    t = {r.search_id: r.total for r in totals.collect()}
    for row in route_tier(reqs, NOW).collect():
        req = SearchRequest.parse(row.tenant_id, {k: row[k] for k in ("service", "level", "q", "from", "to", "page",
                                                                       "page_size")}, NOW)
        single = run_search(hot, req)
        assert single["total"] == t[row.request_id], row.request_id
        got = [r.log_id for r in page.filter(F.col("search_id") == row.request_id).orderBy("rank").collect()]
        assert got == [e["log_id"] for e in single["entries"]], row.request_id


def test_batch_search_prunes_hot_partitions_at_run_time(spark, hot):
    page, _ = search_many(hot, route_tier(fx.search_requests(spark), NOW))
    plan = page._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "FileScan" in line][0]
    assert "dynamicpruningexpression" in scan.split("PartitionFilters")[1]


def test_pages_beyond_addressable_depth(spark, hot):
    base = {"from": "2024-01-01T00:00:00Z", "to": "2024-01-31T00:00:00Z"}
    normal = run_search(hot, SearchRequest.parse("tenant-1", {**base, "page_size": "10"}, NOW))
    deep = run_search(hot, SearchRequest.parse("tenant-1", {**base, "page": "9223372036854775807",
                                                            "page_size": "1000"}, NOW))
    assert deep["entries"] == [] and deep["total"] == normal["total"] > 0
    reqs = spark.createDataFrame(
        [("deep", "tenant-1", "", "", "", base["from"], base["to"], "9223372036854775807", "1000"),
         ("first", "tenant-1", "", "", "", base["from"], base["to"], "1", "10")],
        "request_id string, tenant_id string, service string, level string, q string, `from` string, `to` string, "
        "page string, page_size string")
    page, totals = search_many(hot, route_tier(reqs, NOW))
    assert {r.search_id for r in page.collect()} == {"first"}
    assert {r.search_id: r.total for r in totals.collect()} == {"deep": normal["total"], "first": normal["total"]}


def test_requests_are_made_once(spark, tmp_path):
    from driftlog.operators.search import search_tiers

    columns = "request_id string, tenant_id string, service string, level string, q string, `from` string, `to` string, page string, page_size string"
    raw = [("h", "t1", "", "", "", "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", "1", "10"),
           ("c", "t1", "", "", "", "2023-01-01T00:00:00Z", "2024-01-02T00:00:00Z", "1", "10")]
    spark.createDataFrame([*raw, *raw], columns).write.parquet(f"{tmp_path}/asked")
    routed = route_tier(spark.read.parquet(f"{tmp_path}/asked").distinct(), datetime(2024, 1, 30, tzinfo=timezone.utc))
    rows = spark.createDataFrame([entry("a", event=at(5), ingest=at(6))], LOG_ENTRY)
    page, _ = search_tiers(rows, rows, routed)
    assert sorted((r.search_id, r.tier, r.log_id) for r in page.collect()) == [("c", "cold", "a"), ("h", "hot", "a")]
    assert "FileScan" not in page._jdf.queryExecution().executedPlan().toString()
