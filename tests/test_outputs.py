"""Hot table, archive, routing names, live tail."""

from datetime import datetime, timezone

from driftlog.operators.routing import route_keys
from driftlog.operators.tail import tail_fanout
from driftlog.schemas import LOG_ENTRY, SUBSCRIPTION
from driftlog.sources.archive import archive, read_archive
from driftlog.sources.hot import last_write_wins, read_hot, upsert_hot
from tests.helpers import at, entry

WT = datetime(2024, 2, 1, 10, 30, tzinfo=timezone.utc)


def test_last_write_wins_per_day(spark):
    rows = [entry("a", message="old", event=at(0), ingest=at(1)), entry("a", message="new", event=at(5), ingest=at(2)),
            entry("a", message="other-day", event=at(86400 * 2), ingest=at(3)),
            entry("", message="e1", event=at(0), ingest=at(1)), entry("", message="e1", event=at(0), ingest=at(1))]
    out = last_write_wins(spark.createDataFrame(rows, LOG_ENTRY)).collect()
    assert sorted(r.message for r in out) == ["e1", "e1", "new", "other-day"]


def test_upsert_merges_with_existing_partitions(spark, tmp_path):
    path = str(tmp_path / "hot")
    upsert_hot(spark.createDataFrame([entry("a", message="v1", event=at(0), ingest=at(0)),
                                      entry("b", message="b1", event=at(0), ingest=at(0))], LOG_ENTRY), path)
    upsert_hot(spark.createDataFrame([entry("a", message="v2", event=at(1), ingest=at(0))], LOG_ENTRY), path)
    got = sorted((r.log_id, r.message) for r in read_hot(spark, path).collect())
    assert got == [("a", "v2"), ("b", "b1")]  # the later write wins even with an equal ingest time


def test_archive_roundtrip_and_layout(spark, tmp_path):
    rows = [entry("1", tenant_id="t1", event=at(0), ingest=at(0), container="c"),
            entry("2", tenant_id="t1", event=at(1), ingest=at(1)), entry("3", tenant_id="t2", event=at(2), ingest=at(2))]
    path = str(tmp_path / "cold")
    archive(spark.createDataFrame(rows, LOG_ENTRY), path, WT)
    import glob
    dirs = sorted({p.split("/cold/")[1].rsplit("/", 1)[0] for p in glob.glob(f"{path}/**/*.gz", recursive=True)})
    assert dirs == ["tenant=t1/yyyy=2024/mm=02/dd=01/hh=10", "tenant=t2/yyyy=2024/mm=02/dd=01/hh=10"]
    back = read_archive(spark, path).orderBy("log_id").collect()
    assert [(r.log_id, r.tenant_id, r.container) for r in back] == [("1", "t1", "c"), ("2", "t1", ""), ("3", "t2", "")]
    assert back[0].event_timestamp == at(0).replace(tzinfo=None) or back[0].event_timestamp is not None
    assert read_archive(spark, path, tenant="t2").count() == 1


def test_route_keys(spark):
    df = spark.createDataFrame([entry("1", tenant_id="t1", service="api", event=at(0))], LOG_ENTRY)
    r = route_keys(df, WT, 123456).first()
    assert r.partition_key == "t1|api" and r.index_name == "logs-t1-2024-01-01"
    assert r.archive_path == "t1/2024/02/01/10/part-123456.gz"


def test_tail_isolation_filters_and_cap(spark):
    rows = [entry(f"{i}", tenant_id="t0" if i < 10 else "t1", service="view" if i % 2 else "api",
                  level="INFO" if i % 3 else "warn", ingest=at(i)) for i in range(20)]
    subs = spark.createDataFrame([("s1", "t0", "", ""), ("s2", "t0", "api", ""), ("s3", "t1", "", "info"),
                                  ("s4", "t9", "", ""), ("s5", "t0", "", "")], SUBSCRIPTION)
    e = spark.createDataFrame(rows, LOG_ENTRY)
    out = tail_fanout(e, subs, cap=None)
    by = {}
    for r in out.collect():
        by.setdefault(r.subscriber_id, []).append(int(r.log_id))
    assert sorted(by["s1"]) == list(range(10)) and sorted(by["s5"]) == list(range(10))
    assert sorted(by["s2"]) == [0, 2, 4, 6, 8]
    assert sorted(by["s3"]) == [i for i in range(10, 20) if i % 3]  # parameter uppercased; 'warn' entries not folded
    assert "s4" not in by
    capped = tail_fanout(e, subs, cap=3)
    assert sorted(int(r.log_id) for r in capped.filter("subscriber_id = 's2'").collect()) == [0, 2]  # 3 slots: 0,1,2
    assert out.first().frame.startswith('data: {"log_id":') and out.first().frame.endswith("}\n\n")


def test_cold_search_over_archive(spark, tmp_path):
    from driftlog.operators.search import SearchRequest, run_search
    rows = [entry(f"{i}", tenant_id="t1", level="ERROR" if i % 2 else "INFO", message=f"disk {i}",
                  event=at(i * 60), ingest=at(i * 60)) for i in range(10)]
    path = str(tmp_path / "cold")
    archive(spark.createDataFrame(rows, LOG_ENTRY), path, WT)
    cold = read_archive(spark, path, tenant="t1")
    req = SearchRequest.parse("t1", {"level": "ERROR", "from": "2024-01-01T00:00:00Z", "to": "2024-01-01T01:00:00Z",
                                     "page_size": "3"}, WT)
    res = run_search(cold, req)
    assert res["total"] == 5 and [e["log_id"] for e in res["entries"]] == ["9", "7", "5"]


def test_tail_stream_rounds(spark, tmp_path):
    from driftlog.streaming.tail import tail_stream
    rows = [entry(f"{i}", tenant_id="t0", ingest=at(i)) for i in range(10)]
    src = tmp_path / "src"
    spark.createDataFrame(rows, LOG_ENTRY).coalesce(1).write.parquet(str(src / "a"))
    subs = spark.createDataFrame([("s1", "t0", "", "")], SUBSCRIPTION)
    got = []
    q = tail_stream(spark.readStream.schema(LOG_ENTRY).parquet(str(src / "*")), subs,
                    lambda df, bid: got.extend(r.log_id for r in df.collect()), str(tmp_path / "ck"), cap=4,
                    available_now=True)
    q.awaitTermination(300)
    assert sorted(got, key=int) == ["0", "1", "2", "3"]  # one round: the buffer holds 4, the rest is dropped


def test_bus_rows(spark):
    from driftlog.operators.decode import dead_letter, decode_batches
    from driftlog.sources.bus import dead_letter_rows, normalized_rows
    df = spark.createDataFrame([entry("1", tenant_id="t1", service="api", event=at(0), ingest=at(5))], LOG_ENTRY)
    r = normalized_rows(df).first()
    assert r.topic == "logs-normalized" and bytes(r.key) == b"t1|api" and r.timestamp == at(5).replace(tzinfo=None)
    assert bytes(r.value).startswith(b'{"log_id":"1","tenant_id":"t1","service":"api"')
    _, bad = decode_batches(spark.createDataFrame([("nope",)], "value string"))
    d = dead_letter_rows(dead_letter(bad, None)).first()
    assert d.key is None and bytes(d.value).startswith(b'{"reason":"unmarshal error: ')


def test_numeric_looking_tenants_survive_partitioning(spark, tmp_path):
    rows = [entry("1", tenant_id="007", event=at(0), ingest=at(0)), entry("2", tenant_id="7", event=at(0), ingest=at(0))]
    df = spark.createDataFrame(rows, LOG_ENTRY)
    upsert_hot(df, str(tmp_path / "hot"))
    assert sorted(r.tenant_id for r in read_hot(spark, str(tmp_path / "hot")).collect()) == ["007", "7"]
    archive(df, str(tmp_path / "cold"), WT)
    assert sorted(r.tenant_id for r in read_archive(spark, str(tmp_path / "cold")).collect()) == ["007", "7"]
    assert [r.log_id for r in read_archive(spark, str(tmp_path / "cold"), tenant="007").collect()] == ["1"]
