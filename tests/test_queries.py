"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import build
from spendlens.queries import REGISTRY, rough_phase1
from tests.compare import connect, difference

SQL = build()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, folder, name):
    report, rows, _, _ = difference(spark, duck, folder, REGISTRY[name], SQL[name])
    assert not report
    assert rows > 0


def test_registry_and_sql_have_the_same_names():
    assert set(SQL) == set(REGISTRY)


def test_rough_queries_store_what_they_read(spark, folder):
    """No text, tag or digest that none of them reads is written."""
    columns = rough_phase1(spark, folder).columns
    assert len(columns) < 30 and not {"match_text", "merchant_key", "merchant_tokens", "TXN_REF"} & set(columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
