"""Plan shape of every registered query: nothing funnels the data through one partition."""

import __spark_entry__ as se
from tests.conftest import SF001


def test_no_single_partition_exchange_or_cartesian(spark):
    for name, fn in se.queries().items():
        if name == "archive_roundtrip":
            continue  # writes files when built
        plan = fn(spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan, name
        assert "CartesianProduct" not in plan, name


def test_entry_schema_is_stable(spark):
    a = se.entry(spark).schema
    b = se.entry(spark).schema
    assert a == b and [f.name for f in a] == ["log_id", "tenant_id", "service", "level", "message", "event_us",
                                              "ingest_us"]
