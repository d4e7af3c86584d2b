"""The automatic choice between the hash and range plans."""

from driftlog import fixtures as fx
from driftlog.session import estimated_bytes, fold_mode, range_partitions
from tests.conftest import SF001


def test_estimate_is_the_input_volume(spark):
    ev = fx.log_entries(spark, SF001)
    est = estimated_bytes(ev)
    assert 0 < est < 10 * 1024 * 1024  # the events file, not a join product


def test_auto_mode_follows_the_threshold(spark):
    df = fx.log_entries(spark, SF001)
    assert fold_mode(df, "hash") == "hash" and fold_mode(df, "range") == "range"
    assert fold_mode(df, "auto") == "hash"
    spark.conf.set("spark.driftlog.rangeFoldMinBytes", "0")
    try:
        assert fold_mode(df, "auto") == "range"
    finally:
        spark.conf.unset("spark.driftlog.rangeFoldMinBytes")


def test_range_partitions_scale_with_input(spark):
    df = fx.log_entries(spark, SF001)
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert range_partitions(df) == base and range_partitions(df, 7) == 7
    spark.conf.set("spark.driftlog.rangePartitionBytes", "1024")
    try:
        assert range_partitions(df) == -(-estimated_bytes(df) // 1024)
    finally:
        spark.conf.unset("spark.driftlog.rangePartitionBytes")
