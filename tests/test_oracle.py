"""Every registered query against DuckDB on the same files."""

import compare
import pytest

import __spark_entry__ as entry_point
from runledger.samples.oracle import ORACLE
from runledger.samples.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == []


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() == 1
