from pyspark.sql import functions as F

from driftlog import fixtures as fx
from driftlog.operators.alerts import evaluate_rules, match_rules
from driftlog.operators.dedup import dedup_ttl
from driftlog.operators.normalise import normalise
from driftlog.schemas import LOG_ENTRY, RULE
from tests.conftest import SF001
from tests.helpers import at, entry


def _alerts(spark, entries, rules, **kw):
    e = spark.createDataFrame(entries, LOG_ENTRY)
    r = spark.createDataFrame(rules, RULE)
    return evaluate_rules(e, r, **kw)


def rule(name="r", tenant="*", level="", needle="", threshold=3, window=60, hook="h"):
    return (name, tenant, level, needle, threshold, window, hook)


def ev(i, s, tenant="t1", level="ERROR", message="boom"):
    return entry(f"id{i}", tenant_id=tenant, level=level, message=message, ingest=at(s))


def test_fires_at_threshold_and_after(spark):
    a = _alerts(spark, [ev(i, i) for i in range(5)], [rule()]).orderBy("count").collect()
    assert [r["count"] for r in a] == [3, 4, 5]


def test_below_threshold_is_silent(spark):
    assert _alerts(spark, [ev(i, i) for i in range(2)], [rule()]).count() == 0


def test_window_expiry_resets_count(spark):
    rows = [ev(0, 0), ev(1, 30), ev(2, 60), ev(3, 61), ev(4, 62)]
    st = _alerts(spark, rows, [rule(threshold=1)], with_state=True).orderBy("ingest_timestamp").collect()
    assert [r["count"] for r in st] == [1, 2, 3, 1, 2]  # 60 = start + W still counts; 61 opens anew


def test_first_only(spark):
    a = _alerts(spark, [ev(i, i) for i in range(5)], [rule()], first_only=True).collect()
    assert [r["count"] for r in a] == [3]


def test_predicates(spark):
    rows = [ev(0, 0, tenant="t1", level="ERROR", message="Disk FULL"),
            ev(1, 1, tenant="t2", level="error", message="disk full"),
            ev(2, 2, tenant="t1", level="WARN", message="disk full")]
    rules = [rule("star", "*", "Error", "disk", 1), rule("t2", "t2", "", "", 1), rule("none", "", "", "", 1),
             rule("msg", "*", "", "FULL", 1)]
    m = match_rules(spark.createDataFrame(rows, LOG_ENTRY), spark.createDataFrame(rules, RULE))
    got = sorted((r.rule, r.log_id) for r in m.collect())
    assert got == [("msg", "id0"), ("msg", "id1"), ("msg", "id2"), ("star", "id0"), ("star", "id1"), ("t2", "id1")]


def test_same_name_rules_share_a_window(spark):
    rows = [ev(0, 0, message="a b"), ev(1, 1, message="a b")]
    rules = [rule("dup", needle="a", threshold=2), rule("dup", needle="b", threshold=2)]
    st = _alerts(spark, rows, rules, with_state=True).orderBy("ingest_timestamp", "rule_pos").collect()
    assert [r["count"] for r in st] == [1, 2, 3, 4]


def test_fixture_counts(spark):
    good, _ = normalise(fx.log_entries(spark, SF001))
    dd = dedup_ttl(good, 300, order=["log_id", "shift"])
    st = evaluate_rules(dd, fx.rules(spark), order=["log_id", "shift"], with_state=True)
    got = {r.rule: (r.m, r.w, r.a) for r in st.groupBy("rule").agg(
        F.count("*").alias("m"), F.countDistinct("tenant_id", "window_start").alias("w"),
        F.sum((F.col("count") >= F.col("rule_threshold")).cast("int")).alias("a")).collect()}
    assert got == {"high-error-rate": (209, 144, 12), "purchase-seen": (17, 16, 17),
                   "tenant1-busy": (234, 177, 0), "every-event": (1022, 931, 1022)}


def test_many_rules_path_equals_broadcast_path(spark, monkeypatch):
    import driftlog.operators.alerts as al
    rows = [ev(i, i, tenant=f"t{i % 3}", level="ERROR" if i % 2 else "INFO", message=f"disk {i}") for i in range(30)]
    rules = [rule(f"r{j}", "*" if j % 3 == 0 else f"t{j % 3}", "error" if j % 2 else "", "" if j % 4 else "disk",
                  1 + j % 3, 5) for j in range(12)]
    e = spark.createDataFrame(rows, LOG_ENTRY)
    r = spark.createDataFrame(rules, RULE)
    want = sorted((x.rule, x.log_id) for x in match_rules(e, r).collect())
    monkeypatch.setattr(al, "MAX_BROADCAST_RULES", 2)  # tenant rules by shuffle, wildcard rules sliced
    got = sorted((x.rule, x.log_id) for x in match_rules(e, r).collect())
    assert got == want and len(want) > 0


def test_aligned_tumbling_windows(spark):
    rows = [ev(0, 50), ev(1, 59), ev(2, 61), ev(3, 119), ev(4, 121)]
    st = _alerts(spark, rows, [rule(threshold=1, window=60)], with_state=True, aligned=True) \
        .orderBy("ingest_timestamp").collect()
    # epoch-aligned minutes: [0,60) has 50,59; [60,120) has 61,119; [120,180) has 121
    assert [r["count"] for r in st] == [1, 2, 1, 2, 1]
