"""The correctness gate inside the test suite: every registered query of the log side against its DuckDB oracle, and
those that fold or number by key in range mode as well."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as se
from tests.conftest import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracles import TABLES, digest, type_diffs  # noqa: E402

from driftlog.plans.catalog import QUERIES as CORE  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


FOLDS = ["dedup_ttl", "evaluate_rules", "alerts_aligned", "throttle", "running_counter", "assemble_batches", "normalized"]


@pytest.fixture
def range_mode(spark):
    spark.conf.set("spark.driftlog.rangeFoldMinBytes", "0")
    yield
    spark.conf.unset("spark.driftlog.rangeFoldMinBytes")


def test_every_query_has_an_oracle():
    from driftlog.plans.oracles import ORACLES

    assert set(CORE) == set(ORACLES)


@pytest.mark.parametrize("name", FOLDS)
def test_query_in_range_mode_matches_oracle(spark, duck, range_mode, name):
    compare(spark, duck, name)


def compare(spark, duck, name):
    df = se.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(se.oracle_sql()[name])
    assert type_diffs(df, res) == []
    orows = res.fetchall()
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_matches_oracle(spark, duck, name):
    compare(spark, duck, name)
