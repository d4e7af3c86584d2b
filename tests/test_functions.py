from pyspark.sql import functions as F

from driftlog.functions import canonical_level, extract_level, is_single_json, json_quote, log_id, tokens
from driftlog.functions.text import equal_fold, query_terms

LEVEL_CASES = [
    ("[ERROR] something failed", "ERROR"),
    ("error: connection refused", "ERROR"),
    ("WARN: disk usage high", "WARN"),
    ("[warn] retrying", "WARN"),
    ("[INFO] started service", "INFO"),
    ("info: processing item", "INFO"),
    ("DEBUG trace value=42", "DEBUG"),
    ("[FATAL] unrecoverable error", "ERROR"),  # error is tried before fatal
    ("[FATAL] system crash", "FATAL"),
    ("fatal crash detected", "FATAL"),
    ("no level here", "INFO"),
    ("", "INFO"),
    ("random text", "INFO"),
    ("terror in the night", "ERROR"),  # substring match, no word boundary
    ("ınfo with dotless i", "INFO"),    # no ASCII 'info' -> default, never a Unicode fold
]


def test_extract_level(spark):
    df = spark.createDataFrame(LEVEL_CASES, "line string, want string")
    got = df.select("want", extract_level(F.col("line")).alias("got")).collect()
    assert [(r.want, r.got) for r in got] == [(w, w) for _, w in LEVEL_CASES]


CANON = [("  info  ", "INFO"), ("\terror ", "ERROR"), (" warn\n", "WARN"), ("", "INFO"), ("   ", "INFO"),
         ("debug", "DEBUG"), ("Custom", "CUSTOM"), ("　fatal ", "FATAL")]


def test_canonical_level(spark):
    df = spark.createDataFrame(CANON, "lvl string, want string")
    got = [r.got for r in df.select(canonical_level(F.col("lvl")).alias("got")).collect()]
    assert got == [w for _, w in CANON]


JSON_CASES = [("{}", True), ('{"a":[1,2]}', True), ("null", True), ("5", True), ('"x"', True), ("", False),
              ("not-json", False), ("{} x", False), ("{}{}", False), ("{},{}", False), ("{}] x", False),
              ("{}} x", False), ("{'a':1}", False), ("NaN", False), ("01", False), ("{a:1}", False)]


def test_single_json_gate(spark):
    df = spark.createDataFrame(JSON_CASES, "v string, ok boolean")
    got = [r.g for r in df.select(is_single_json(F.col("v")).alias("g")).collect()]
    assert got == [ok for _, ok in JSON_CASES]


def test_json_quote(spark):
    df = spark.createDataFrame([('a"b\nc',)], "v string")
    assert df.select(json_quote(F.col("v")).alias("q")).first().q == '"a\\"b\\nc"'


def test_log_id_is_16_hex_and_deterministic(spark):
    df = spark.sql("select 'agent' a, 'line' l, timestamp'2024-01-01 00:00:00' t")
    r = df.select(log_id(F.col("a"), F.col("l"), F.col("t")).alias("id")).first().id
    import hashlib
    want = hashlib.sha256(b"agentline1704067200000000").hexdigest()[:16]
    assert r == want


def test_tokens_and_query_terms(spark):
    df = spark.createDataFrame([("Disk FULL on /dev/sda1, retry_count=3 — café",)], "m string")
    got = df.select(tokens(F.col("m")).alias("t")).first().t
    assert got == ["disk", "full", "on", "dev", "sda1", "retry_count", "3", "café"]
    assert query_terms("k=7 K=42") == ["42", "7", "k"]


def test_equal_fold(spark):
    df = spark.createDataFrame([("error", "ERROR", True), ("Warn", "wArN", True), ("warn", "warning", False)],
                               "a string, b string, want boolean")
    got = [r.g for r in df.select(equal_fold(F.col("a"), F.col("b")).alias("g")).collect()]
    assert got == [True, True, False]
