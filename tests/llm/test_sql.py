"""Queries with SQL equal DuckDB's answer, and the registry keeps its contract."""

import pytest

import __spark_entry__ as contract
from checks.compare import connect, rows_of, spark_rows
from colloquy.llm import queries


@pytest.mark.parametrize("name", list(queries.SQL))
def test_equals_sql(spark, sf_dir, name):
    result = connect(sf_dir).execute(queries.SQL[name])
    expected = rows_of([c[0] for c in result.description], result.fetchall())
    assert spark_rows(queries.QUERIES[name](spark, sf_dir)) == expected


def test_all_operators_and_the_pipeline_are_registered():
    names = set(contract.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert set(contract.oracle_sql()) <= names


def test_no_sql_reads_a_sample():
    for sql in queries.SQL.values():
        assert not {"limit", "sample", "tablesample"} & set(sql.lower().split())
