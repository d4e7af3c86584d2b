from datetime import datetime, timezone

from pyspark.sql import functions as F

from driftlog import fixtures as fx
from driftlog.operators.ingest import assemble_batches, authorize, parse_lines, stamp_ingest
from driftlog.operators.numbering import number_within
from driftlog.operators.sessions import session_counter
from tests.conftest import SF001
from tests.helpers import at

NOW = datetime(2024, 3, 1, tzinfo=timezone.utc)


def test_parse_lines(spark):
    lines = spark.createDataFrame([("a1", "[warn] disk", at(0)), ("a1", "", at(1))], "agent_id string, line string, ts timestamp")
    e = parse_lines(lines, "t", "svc", "h", "prod").orderBy("event_timestamp").collect()
    assert [x.level for x in e] == ["WARN", "INFO"] and e[0].tenant_id == "t" and len(e[0].log_id) == 16
    assert e[0].event_timestamp == e[0].ingest_timestamp


def test_numbering_spreads_a_hot_key(spark):
    df = spark.range(0, 5000).select((F.when(F.col("id") < 4000, F.lit("hot")).otherwise(F.lit("cold"))).alias("k"),
                                     F.col("id"))
    out = number_within(df, ["k"], ["id"], num_partitions=6, mode="range")
    rows = out.collect()
    hot = sorted((r.id, r.row_no) for r in rows if r.k == "hot")
    assert [n for _, n in hot] == list(range(1, 4001))
    assert sorted(r.row_no for r in rows if r.k == "cold") == list(range(1, 1001))


def test_assemble_and_stamp(spark):
    lines = fx.raw_lines(spark, SF001)
    e = parse_lines(lines, "t", "docs", "h", "test")
    b = assemble_batches(e, 3, sent_at=F.lit(NOW))
    sizes = b.select(F.size("entries").alias("n")).collect()
    assert max(r.n for r in sizes) <= 3 and sum(r.n for r in sizes) == e.count()
    s = stamp_ingest(b.withColumn("tenant_id", F.lit("tenant-x")), "tenant_id", F.lit(NOW))
    x = s.select("key", F.explode("entries").alias("e")).select("key", "e.tenant_id", "e.ingest_timestamp").distinct().collect()
    assert len(x) == 1 and x[0].key == "tenant-x|docs" and x[0].tenant_id == "tenant-x"


def test_empty_batch_yields_nothing(spark):
    from driftlog.schemas import LOG_BATCH
    b = spark.createDataFrame([("a", [], None)], LOG_BATCH).withColumn("tenant_id", F.lit("t"))
    assert stamp_ingest(b).count() == 0


def test_authorize_matrix(spark):
    reqs = spark.createDataFrame([("1", "t1", "k1"), ("2", "t1", "bad"), ("3", "", "k1"), ("4", "t9", "k9")],
                                 "request_id string, tenant_id string, api_key string")
    keys = spark.createDataFrame([("t1", "k1")], "tenant_id string, api_key string")
    ok, no = authorize(reqs, keys)
    assert sorted(r.request_id for r in ok.collect()) == ["1"] and no.count() == 3
    ok, no = authorize(reqs, keys.limit(0))  # empty key table: any non-empty tenant
    assert sorted(r.request_id for r in ok.collect()) == ["1", "2", "4"]


def test_session_counter_boundary(spark):
    df = spark.createDataFrame([("k", 0), ("k", 600), ("k", 1201), ("k", 1300)], "k string, s long").withColumn(
        "ts", F.timestamp_seconds("s"))
    got = sorted(r["count"] for r in session_counter(df, ["k"], "ts", 600).collect())
    assert got == [2, 2]  # exactly 600 s keeps the session; 601 s resets it


def test_numbering_matches_row_number_random(spark):
    import random

    from pyspark.sql import Window
    rnd = random.Random(9)
    rows = [(rnd.choice(["a"] * 8 + ["b", "c", "d"]), rnd.randrange(0, 500), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, t long, tie long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = {r.tie: r.row_no for r in number_within(df, ["k"], ["t", "tie"], num_partitions=9,
                                                      mode="range").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    w = Window.partitionBy("k").orderBy("t", "tie")
    want = {r.tie: r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == want


def test_running_counter(spark):
    from driftlog.operators.sessions import running_counter
    df = spark.createDataFrame([("k", 0, "a"), ("k", 600, "b"), ("k", 1201, "c"), ("k", 1300, "d"), ("j", 5, "e")],
                               "k string, s long, id string").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.id: r.counter for r in running_counter(df, ["k"], "ts", 600, order=["id"]).collect()}
    assert got == {"a": 1, "b": 2, "c": 1, "d": 2, "e": 1}


def test_numbering_many_keys_tiny_batches(spark):
    import random

    from pyspark.sql import Window
    rnd = random.Random(21)
    rows = []
    for k in range(60):
        size = rnd.choice([1, 1, 2, 3, 50, 400])
        rows += [(f"k{k:03d}", rnd.randrange(0, 1000), len(rows) + i) for i in range(size)]
    df = spark.createDataFrame(rows, "k string, t long, tie long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = {r.tie: r.row_no for r in number_within(df, ["k"], ["t", "tie"], num_partitions=13, mode="range").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    w = Window.partitionBy("k").orderBy("t", "tie")
    want = {r.tie: r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == want
