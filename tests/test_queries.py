"""Every registered query beside its SQL twin, at the smallest scale."""

import pytest

import __spark_entry__ as entry_module
from tools.compare import check, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query(spark, con, sf_dir, name):
    assert check(spark, con, name, sf_dir) is None


def test_twins_have_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 20
