"""Every registered query against its SQL twin, run by DuckDB."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entries

duckdb = pytest.importorskip("duckdb")

TABLES = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not TABLES.is_dir(), reason="no test tables")

SPARK_NAMES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double"}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("name", entries.oracle_sql())
def test_query_equals_sql(spark, oracle, name):
    result = entries.queries()[name](spark, str(TABLES))
    columns = sorted(result.columns)
    want = oracle.sql(entries.oracle_sql()[name])
    types = dict(zip(want.columns, map(str, want.types), strict=True))
    assert {c: SPARK_NAMES.get(t, t.lower()) for c, t in types.items()} == dict(result.dtypes)
    got = in_order(result.select(*[f"`{c}`" for c in columns]).collect())
    assert got == in_order(want.select(*[f'"{c}"' for c in columns]).fetchall())


def test_every_query_but_those_beyond_sql_has_sql():
    corpus = {} if entries.corpus_queries is None else {*entries.corpus_queries.queries(), "pipeline"}
    assert set(entries.queries()) - set(entries.oracle_sql()) <= set(corpus)


def test_flagship(spark):
    result = entries.entry(spark)
    assert result.columns[-1] == "hourly_avg_value" and not result.isEmpty()
