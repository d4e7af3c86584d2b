import json

from driftlog.__main__ import main


def test_cli_pipeline_then_search(spark, tmp_path, capsys):
    raw = tmp_path / "raw"
    raw.mkdir()
    batch = {"agent_id": "a", "entries": [
        {"log_id": f"x{i}", "tenant_id": "t1", "service": "api", "level": "error", "message": f"disk {i}",
         "event_timestamp": f"2024-01-01T00:0{i}:00Z", "ingest_timestamp": f"2024-01-01T00:0{i}:01Z"}
        for i in range(5)]}
    (raw / "b.json").write_text(json.dumps(batch))
    (raw / "bad.json").write_text("nope")
    out = tmp_path / "out"
    assert main(["pipeline", "--raw", str(raw), "--out", str(out)]) == 0
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts == {"normalized": 5, "dead_letter": 1}
    assert main(["search", "--out", str(out), "--tenant", "t1", "--level", "ERROR", "--from", "2024-01-01T00:00:00Z",
                 "--to", "2024-01-01T01:00:00Z", "--page-size", "2", "--hot-days", "100000"]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["total"] == 5 and [e["log_id"] for e in res["entries"]] == ["x4", "x3"]


def test_cli_stream_available_now(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    batch = {"entries": [{"log_id": "s1", "tenant_id": "t1", "message": "m",
                          "ingest_timestamp": "2024-01-01T00:00:00Z"}]}
    (raw / "b.json").write_text(json.dumps(batch))
    (raw / "junk.json").write_text("{} x")
    out = tmp_path / "out"
    assert main(["stream", "--raw", str(raw), "--out", str(out), "--checkpoint", str(tmp_path / "ck"),
                 "--available-now"]) == 0
    assert spark.read.parquet(str(out / "normalized")).count() == 1
    assert spark.read.parquet(str(out / "dead_letter")).count() == 1


def test_cli_alerts(spark, tmp_path, capsys):
    raw = tmp_path / "raw"
    raw.mkdir()
    batch = {"entries": [{"log_id": f"a{i}", "tenant_id": "t1", "level": "error", "message": "boom",
                          "ingest_timestamp": f"2024-01-01T00:00:0{i}Z"} for i in range(4)]}
    (raw / "b.json").write_text(json.dumps(batch))
    out = tmp_path / "out"
    main(["pipeline", "--raw", str(raw), "--out", str(out)])
    rules = tmp_path / "rules.json"
    rules.write_text(json.dumps([{"name": "r", "tenant_id": "*", "level": "ERROR", "message_contains": "",
                                  "threshold": 3, "window_seconds": 60, "webhook": "h"}]))
    capsys.readouterr()
    assert main(["alerts", "--out", str(out), "--rules", str(rules), "--result", str(tmp_path / "alerts")]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"alerts": 2}


def test_cli_lines_to_batches_to_a_compacted_table(spark, tmp_path, capsys):
    lines, out = tmp_path / "lines", tmp_path / "out"
    lines.mkdir()
    (lines / "a.log").write_text("first ERROR\nsecond\nthird warn\n")
    (lines / "b.log").write_text("fourth\nfifth needle\n")
    said = lambda: json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert main(["batches", "--lines", str(lines), "--out", str(tmp_path / "raw"), "--agent", "ag", "--tenant", "t1", "--service", "svc", "--size", "2"]) == 0
    assert said() == {"batches": 3}
    for k in (0, 0, 1):  # the first batch twice
        main(["pipeline", "--raw", str(tmp_path / "raw"), "--out", str(out), "--batch-id", str(k)])
        assert said()["dead_letter"] == 0
    search = ["search", "--out", str(out), "--tenant", "t1", "--q", "needle", "--hot-days", "30"]
    main(search)
    before = said()
    assert main(["compact", "--out", str(out)]) == 0 and said() == {"generations": 1}
    main(search)
    assert said() == before and [e["message"] for e in before["entries"]] == ["fifth needle"]
