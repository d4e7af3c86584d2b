from pyspark.sql import functions as F

from driftlog import fixtures as fx
from driftlog.operators.decode import REASON_NORMALISE, REASON_UNMARSHAL, dead_letter, decode_batches
from driftlog.operators.normalise import normalise

BAD = ["", "not-json", "[]", '"x"', "5", '{"entries":{}}', '{"entries":[5]}', '{"entries":[{"message":5}]}',
       '{"entries":[{"fields":{"a":1}}]}', "{} x", "{}{}", "{},{}", "{}] x", "{}} x", '{"a":1,"a":2}',
       '{"entries":[{"event_timestamp":"2026-04-26"}]}', '{"entries":[{"event_timestamp":"2026-04-26 10:00:00Z"}]}',
       '{"entries":[{"event_timestamp":"garbage"}]}', '{"agent_id":5}', '{"sent_at":"yesterday"}']
EMPTY_OK = ["null", "{}", '{"entries":null}', '{"entries":[]}', '{"unknown":{"x":1}}']


def _decode(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    return decode_batches(df)


def test_whole_message_rejected(spark):
    ents, bad = _decode(spark, BAD)
    assert ents.count() == 0
    reasons = [r.reason for r in bad.orderBy("i").collect()]
    assert len(reasons) == len(BAD)
    assert all(r.startswith(REASON_UNMARSHAL) for r in reasons)


def test_empty_but_valid_messages(spark):
    ents, bad = _decode(spark, EMPTY_OK)
    assert ents.count() == 0 and bad.count() == 0


def test_null_element_is_an_empty_entry_then_rejected(spark):
    ents, bad = _decode(spark, ['{"entries":[null]}'])
    assert bad.count() == 0
    row = ents.first()
    assert row.tenant_id == "" and row.message == "" and row.event_timestamp is None
    good, rejected = normalise(ents)
    assert good.count() == 0 and rejected.count() == 1
    dl = dead_letter(None, rejected).first()
    assert dl.reason == REASON_NORMALISE and dl.payload.startswith('{"log_id":""')


def test_one_bad_entry_rejects_the_batch(spark):
    v = '{"entries":[{"tenant_id":"t","message":"ok"},{"tenant_id":"t","message":7}]}'
    ents, bad = _decode(spark, [v])
    assert ents.count() == 0 and bad.count() == 1


def test_types_times_and_fields(spark):
    v = ('{"agent_id":"a1","sent_at":"2024-01-01T00:00:00Z","entries":[{"log_id":"x","tenant_id":"t",'
         '"message":"m","level":null,"event_timestamp":"2026-04-26T10:00:00.123456789+05:30",'
         '"ingest_timestamp":"0001-01-01T00:00:00Z","fields":{"a":"b","c":null},"extra":[1]}]}')
    ents, bad = _decode(spark, [v])
    assert bad.count() == 0
    r = ents.select("*", F.unix_micros("event_timestamp").alias("us")).first()
    assert r.agent_id == "a1" and r.level == "" and r.ingest_timestamp is None
    from datetime import datetime, timezone
    want = int(datetime(2026, 4, 26, 4, 30, tzinfo=timezone.utc).timestamp()) * 1_000_000 + 123456
    assert r.us == want  # UTC, nanoseconds truncated to micros
    assert r.fields == {"a": "b", "c": ""}


def test_dead_letter_payloads(spark):
    ents, bad = _decode(spark, ["not-json", '{"entries":{}}'])
    got = sorted(r.payload for r in dead_letter(bad, None).collect())
    assert got == ['"not-json"', '{"entries":{}}']
    env = dead_letter(bad, None).orderBy("payload").first().envelope
    assert env.startswith('{"reason":"unmarshal error: ') and env.endswith(',"payload":"not-json"}')


def test_body_cap(spark):
    from driftlog.operators.decode import cap_body
    df = spark.createDataFrame([('{"entries":[]}' + " " * 20,)], "v string")
    cut = df.select(cap_body(F.col("v"), 10).alias("c")).first().c
    assert cut == '{"entries"'


def test_fixture_batches(spark):
    from tests.conftest import SF001
    ents, bad = decode_batches(fx.raw_batches(spark, SF001))
    assert bad.count() == 18
