"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from deskmeter.queries import QUERIES as LIBRARY  # noqa: E402

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def warehouse(small):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{small}/{name}.parquet'")
    return con


def test_every_statement_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(LIBRARY) - set(ORACLE) == {"svm_rff_metrics", "mlp_metrics"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, small, warehouse, name):
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    answer = warehouse.execute(ORACLE[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = [tuple(r[i] for i in at) for r in answer.fetchall()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
