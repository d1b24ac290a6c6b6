"""Every checked query against its SQL in DuckDB, on the given tables."""

import math
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import ROOT

sys.path.insert(0, str(ROOT))
import __spark_entry__ as contract  # noqa: E402

from corpusflow.plans.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, abs_tol=1.01e-6)
    return a == b


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    actual = sorted(tuple(r) for r in df.select(*columns).collect())
    relation = duck.sql(contract.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    expected = sorted(relation.select(*columns).fetchall())
    assert actual, "empty result"
    assert len(actual) == len(expected)
    differing = [(a, e) for a, e in zip(actual, expected) if not all(map(same, a, e))]
    assert not differing, differing[:5]


def test_same_names():
    assert QUERIES.keys() <= contract.queries().keys()
    assert QUERIES.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark, sf_dir):
    assert contract.entry(spark).count() == 10
