from driftlog import fixtures as fx
from driftlog.operators.dedup import dedup_ttl
from driftlog.operators.normalise import normalise
from driftlog.plans.pipeline import process
from tests.conftest import SF001
from tests.helpers import at, entry


def _dd(spark, rows, ttl=300, keys=("log_id",)):
    from driftlog.schemas import LOG_ENTRY
    df = spark.createDataFrame(rows, LOG_ENTRY)
    return dedup_ttl(df, ttl, keys=list(keys))


def test_same_id_in_one_batch(spark):
    rows = [entry("a", message="first", ingest=at(0)), entry("a", message="second", ingest=at(0))]
    assert _dd(spark, rows).count() == 1


def test_ids_are_global_across_tenants_unless_scoped(spark):
    rows = [entry("a", tenant_id="t1", ingest=at(0)), entry("a", tenant_id="t2", ingest=at(1))]
    assert _dd(spark, rows).count() == 1
    assert _dd(spark, rows, keys=("tenant_id", "log_id")).count() == 2


def test_ttl_edges(spark):
    rows = [entry("a", message=str(s), ingest=at(s)) for s in (0, 299.999999, 300, 300.5, 600, 601)]
    kept = sorted(float(r.message) for r in _dd(spark, rows).collect())
    # 0 opens; 299.999999 dup; 300 is exactly first+TTL -> new; 300.5 dup; 600 = 300+300 -> new; 601 dup
    assert kept == [0.0, 300.0, 600.0]


def test_ttl_not_extended_by_duplicates(spark):
    rows = [entry("a", message=str(s), ingest=at(s)) for s in (0, 200, 400)]
    assert sorted(r.message for r in _dd(spark, rows).collect()) == ["0", "400"]


def test_empty_ids_never_deduplicated(spark):
    rows = [entry("", ingest=at(0)), entry("", ingest=at(0)), entry("", ingest=at(1))]
    assert _dd(spark, rows).count() == 3


def test_rejected_entry_does_not_claim_its_id(spark):
    v = ('{"entries":[{"log_id":"x","tenant_id":"","message":"m","ingest_timestamp":"2024-01-01T00:00:00Z"},'
         '{"log_id":"x","tenant_id":"t","message":"m","ingest_timestamp":"2024-01-01T00:00:01Z"}]}')
    out = process(spark.createDataFrame([(v,)], "value string"))
    assert out.entries.count() == 1 and out.dead.count() == 1


def test_fixture_counts(spark):
    good, _ = normalise(fx.log_entries(spark, SF001))
    dd = dedup_ttl(good, 300, order=["log_id", "shift"])
    by_shift = {r.shift: r["count"] for r in dd.groupBy("shift").count().collect()}
    assert dd.count() == 1022 and by_shift == {0: 980, 300: 12, 600: 30}


def test_prefilter_matches_plain_fold(spark):
    good, _ = normalise(fx.log_entries(spark, SF001))
    plain = dedup_ttl(good, 300, order=["log_id", "shift"], mode="hash", prefilter=False)
    pre = dedup_ttl(good, 300, order=["log_id", "shift"], mode="hash", prefilter=True)
    pre_range = dedup_ttl(good, 300, order=["log_id", "shift"], mode="range", prefilter=True)
    key = lambda r: (r.log_id, r.shift, r.event_id)
    a = sorted(map(key, plain.collect()))
    assert a == sorted(map(key, pre.collect())) == sorted(map(key, pre_range.collect()))
    assert len(a) == 1022
