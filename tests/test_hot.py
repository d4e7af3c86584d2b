"""Hot table: generations by batch id, merge on read, compaction; ledger of the streaming outputs."""

import datetime as dt

import pytest

from driftlog.schemas import LOG_ENTRY
from driftlog.sources.files import Folder
from driftlog.sources.hot import HotTable, last_write_wins
from driftlog.streaming import pipeline as sp
from tests.helpers import at, entry

DAY = 86_400


def frame(spark, rows):
    return spark.createDataFrame(rows, LOG_ENTRY)


def content(table):
    return sorted((r.log_id, r.message, str(r.event_date)) for r in table.read().collect())


@pytest.fixture
def table(spark, tmp_path):
    return HotTable(spark, str(tmp_path / "hot"))


def test_the_same_batch_twice_changes_nothing(spark, table):
    rows = frame(spark, [entry("a", message="1", event=at(0), ingest=at(0)), entry("", message="none", event=at(0), ingest=at(0)), entry("", message="none", event=at(0), ingest=at(0))])
    assert table.append(rows, batch_id=0) and not table.append(rows, batch_id=0)
    first = content(table)
    assert [m for _, m, _ in first] == ["none", "none", "1"]
    assert table.append(rows, batch_id=0, writer="another query")  # its batch ids are its own
    assert len(content(table)) == 5


def test_an_uncommitted_generation_is_overwritten(spark, table):
    table._write(last_write_wins(frame(spark, [entry("x", message="half", event=at(0), ingest=at(0))]).transform(lambda d: __import__("driftlog.sources.hot", fromlist=["x"]).to_hot_rows(d))), f"{0:020d}")
    assert content(table) == []
    table.append(frame(spark, [entry("a", message="1", event=at(0), ingest=at(0))]), batch_id=0)
    assert content(table) == [("a", "1", "2024-01-01")]


def test_later_generations_win_whatever_the_arrival(spark, table):
    table.append(frame(spark, [entry("a", message="v1", event=at(0), ingest=at(9)), entry("b", message="b1", event=at(0), ingest=at(0))]), batch_id=0)
    table.append(frame(spark, [entry("a", message="v2", event=at(1), ingest=at(0)), entry("a", message="other day", event=at(DAY), ingest=at(0))]), batch_id=1)
    want = [("a", "other day", "2024-01-02"), ("a", "v2", "2024-01-01"), ("b", "b1", "2024-01-01")]
    assert content(table) == want


def test_filters_on_tenant_and_day_prune_below_the_merge(spark, table):
    for k in range(3):
        table.append(frame(spark, [entry(f"{k}", tenant_id=f"t{k}", event=at(k * DAY), ingest=at(0))]), batch_id=k)
    plan = table.read().where("tenant_id = 't1' and event_date = date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tenant_id" in plan and "(tenant_id#" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_compaction_keeps_the_rows_and_drops_old_generations(spark, table):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    for k in range(4):
        table.append(frame(spark, [entry("a", message=f"v{k}", event=at(0), ingest=at(0)), entry("a", message=f"w{k}", event=at(DAY), ingest=at(0)), entry("", message="e", event=at(DAY), ingest=at(0))]), batch_id=k)
    want = content(table)
    assert want == [("", "e", "2024-01-02")] * 4 + [("a", "v3", "2024-01-01"), ("a", "w3", "2024-01-02")]
    table.compact(days[:1])
    assert content(table) == want
    table.append(frame(spark, [entry("a", message="late", event=at(0), ingest=at(0))]), batch_id=4)
    want[4] = ("a", "late", "2024-01-01")
    assert content(table) == want
    table.compact(days[1:])
    assert content(table) == want
    table.compact()
    assert content(table) == want and len(table.manifest()["live"]) == 1
    table.vacuum(keep=1)
    assert content(table) == want and len(Folder(spark, table.path).names("data")) == 1
    assert not table.append(frame(spark, [entry("z", event=at(0), ingest=at(0))]), batch_id=2)  # still known


def test_repeated_rows_without_an_id_come_back_in_full(spark):
    rows = frame(spark, [entry("", message="e", event=at(0), ingest=at(0))]).crossJoin(spark.range(10_001).select()).select(*LOG_ENTRY.names)
    assert last_write_wins(rows).count() == 10_001


def test_empty_table(spark, table):
    assert table.read().count() == 0
    table.compact()
    table.vacuum()


@pytest.mark.parametrize("broken", ["normalized", "hot", "cold", "dead_letter"])
def test_a_failed_output_is_written_alone_on_the_retry(spark, tmp_path, monkeypatch, broken):
    rows = [entry("a", message="1", event=at(0), ingest=at(0)), entry("", message="2", event=at(0), ingest=at(5))]
    batch = frame(spark, rows).selectExpr("'entry' as kind", "null as reason", "null as payload", "*").unionByName(
        frame(spark, [entry("r")]).selectExpr("'bad' as kind", "'why' as reason", "'{}' as payload", "*"))
    calls = []

    def watch(name, fails):
        real = getattr(sp, f"write_{name}")

        def write(df, out, batch_id, writer):
            calls.append(name)
            if fails.pop(name, False):
                raise OSError("no space")
            real(df, out, batch_id, writer)

        monkeypatch.setattr(sp, f"write_{name}", write)

    fails = {broken: True}
    for name in ("normalized", "hot", "cold", "dead_letter"):
        watch(name, fails)
    out, calm = str(tmp_path / "out"), str(tmp_path / "calm")
    with pytest.raises(RuntimeError, match=broken):
        sp.write_outputs(batch, 7, out)
    assert sorted(calls) == ["cold", "dead_letter", "hot", "normalized"]
    calls.clear()
    sp.write_outputs(batch, 7, out)
    assert calls == [broken]
    sp.write_outputs(batch, 7, out)
    assert calls == [broken]  # a batch with all its records is not touched
    monkeypatch.undo()
    sp.write_outputs(batch, 7, calm)
    read = lambda at_: (sorted(map(str, spark.read.parquet(f"{at_}/normalized").collect())), sorted(map(str, spark.read.parquet(f"{at_}/dead_letter").collect())),
                        content(HotTable(spark, f"{at_}/hot")), sorted(r.value for r in spark.read.text(f"{at_}/cold").collect()))
    assert read(out) == read(calm)


def test_a_rare_term_opens_few_files(spark, table):
    days = 12
    rows = [entry(f"{d}-{k}", message=f"common {'needle' if (d, k) == (7, 3) else 'hay'}", event=at(d * DAY + k), ingest=at(k)) for d in range(days) for k in range(5)]
    table.append(frame(spark, rows), batch_id=0)
    table.append(frame(spark, [entry("7-4", message="common needle gone", event=at(7 * DAY), ingest=at(0))]), batch_id=1)
    hits = lambda df: sorted(r.log_id for r in df.where("array_contains(message_terms, 'needle')").collect())
    table.index_terms()
    assert hits(table.read_terms(["needle"])) == ["7-3", "7-4"] and table.read_terms(["needle"]).count() == 60  # two generations: all rows
    table.compact()
    assert table.read_terms(["needle"]).count() == 60  # not indexed yet
    table.index_terms()
    some = table.read_terms(["needle", "no such term"])
    assert hits(some) == hits(table.read()) == ["7-3", "7-4"]
    assert len(some.inputFiles()) == 1 and len(table.read().inputFiles()) == days
    assert table.read_terms(["nothing"]).count() == table.read_terms([]).count() == 0
    table.vacuum(keep=1)
    assert len(Folder(spark, table.path).names("_terms")) == 1
