import base64
import gzip
import json

from pyspark.sql import functions as F

from driftlog.operators.decode import decode_batches
from driftlog.operators.ingest import parse_lines
from driftlog.sources.files import read_batch_files, read_lines, read_spool


def _batch(n):
    return json.dumps({"agent_id": "a", "entries": [{"log_id": f"x{i}", "tenant_id": "t", "message": f"m{i}"}
                                                    for i in range(n)]})


def test_gzip_and_plain_batches_and_spool(spark, tmp_path):
    d = tmp_path / "spool"
    d.mkdir()
    with gzip.open(d / "b1.json.gz", "wt") as f:
        f.write(_batch(3))
    (d / "b2.json").write_text(_batch(2))
    (d / "broken.json").write_text('{"entries": [')
    raw = read_batch_files(spark, str(d))
    ents, bad = decode_batches(raw)
    assert ents.count() == 5 and bad.count() == 1
    assert bad.first().source_file.endswith("broken.json")


def test_body_cap_makes_large_body_invalid(spark, tmp_path):
    d = tmp_path / "big"
    d.mkdir()
    (d / "big.json").write_text(_batch(50))
    ents, bad = decode_batches(read_batch_files(spark, str(d), max_bytes=100))
    assert ents.count() == 0 and bad.count() == 1


def test_rejected_files_keep_all_of_their_payload(spark, tmp_path):
    d = tmp_path / "spool"
    d.mkdir()
    (d / "big.json").write_text(_batch(50))
    (d / "small file.json").write_text(_batch(1))
    whole = gzip.compress(_batch(50).encode())
    (d / "damaged.json.gz").write_bytes(whole[: len(whole) // 2])
    ents, bad = decode_batches(read_batch_files(spark, str(d), max_bytes=100))
    got = {r.source_file.rsplit("/", 1)[1]: r for r in bad.collect()}
    assert ents.count() == 1 and set(got) == {"big.json", "damaged.json.gz"}
    assert got["big.json"].value == _batch(50) and got["big.json"].reason.endswith("body of more than 100 bytes")
    assert base64.b64decode(got["damaged.json.gz"].value) == whole[: len(whole) // 2]


def test_spool_files_are_replayed_whole(spark, tmp_path):
    d = tmp_path / "spool"
    d.mkdir()
    (d / "big.json").write_text(json.dumps({**json.loads(_batch(3)), "pad": "x" * (11 << 20)}))
    ents, bad = decode_batches(read_spool(spark, str(d)))
    assert ents.count() == 3 and bad.count() == 0


def test_lines_to_entries(spark, tmp_path):
    (tmp_path / "app.log").write_text("[ERROR] boom\nall good\n")
    lines = read_lines(spark, str(tmp_path / "app.log")).withColumn("agent_id", F.lit("a1")).withColumn(
        "ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    got = sorted((r.message, r.level) for r in parse_lines(lines, "t", "svc", "h", "prod").collect())
    assert got == [("[ERROR] boom", "ERROR"), ("all good", "INFO")]


def test_stream_lines_picks_up_new_files(spark, tmp_path):
    from driftlog.sources.files import stream_lines
    d = tmp_path / "logs"
    d.mkdir()
    (d / "a.log").write_text("one\ntwo\n")
    (d / "b.log").write_text("three\n")
    q = (stream_lines(spark, str(d), max_files_per_trigger=1).writeStream.format("memory").queryName("lines_t")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert sorted(r.line for r in spark.table("lines_t").collect()) == ["one", "three", "two"]


def conversations(spark, tmp_path, rows):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def test_spool_files_are_bounded_and_replay_whole(spark, tmp_path):
    from driftlog import fixtures as fx
    from driftlog.plans.catalog import q_spool_replay

    text = "x" * 40_000
    rows = [(1 + 61 * (k // 50), k % 50, "user", text) for k in range(300)] + [(2, 0, None, None), (2, 0, None, None), (None, 1, "user", "no part")]
    d = conversations(spark, tmp_path, rows)
    sizes = [len(r["value"]) for r in fx.spool_files(spark, d).collect()]
    assert len(sizes) > 10 and max(sizes) < 2 << 20  # one file of all would be above the limit of a compressed body
    got = sorted((r["form"], r["position"], r["log_id"]) for r in q_spool_replay(spark, d).collect())
    assert got == [("packed", k, f"{1 + 61 * (k // 50)}-{k % 50}") for k in range(300)] + [("plain", 0, "2-0"), ("plain", 1, "2-0")]


def test_file_bytes_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    plan = read_spool(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join Left" in x]
    assert any("LeftSemi" in x and "strategy=broadcast" in x for x in joins) and len(joins) == 2
