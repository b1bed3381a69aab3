"""Every named query against its SQL twin, on the smallest scale."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import compare, duck  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLE:
        same, why, _ = compare(df, con, ORACLE[name])
        assert same, why
    else:
        assert len(df.columns) == len(set(df.columns))
        df.collect()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["key", "name", "number", "mentions", "records", "dominant_in"]
    assert df.count() > 0


def test_twins_have_queries():
    assert set(ORACLE) <= set(QUERIES)
