"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from oracle import connect, differences

from modlens import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, con, name):
    assert differences(catalog.QUERIES[name](spark, SF_DIR), con, catalog.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["source", "n_rows", "n_keyword", "keyword_rate"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
