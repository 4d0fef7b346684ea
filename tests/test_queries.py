"""Every query with SQL equals DuckDB's answer; the others return rows."""

import pytest

import __spark_entry__ as contract
from checks import registry
from checks.compare import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(registry.SQL))
def test_equals_sql(spark, con, sf_dir, name):
    assert difference(con, spark, sf_dir, name) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    result = contract.entry(spark)
    assert result.count() == 5


def test_stop_words_of_the_sql_are_those_of_spark(spark):
    from colloquy.functions.text import english_stop_words

    assert registry.stop_words() == english_stop_words()
    assert len(registry.stop_words()) == 181
