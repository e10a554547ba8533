"""Every registered query that has SQL gives the same rows in both engines."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

DIRECTORY = "/root/testdata/sf0.001"
#: Fits of hundreds of trees take minutes each; `python tests/compare.py DIR NAME` compares them.
LONG_FITS = {"gbt_mid_fit", "gbt_deep_fit", "gbt_symmetric_fit", "voting_fit", "weighted_fit", "stacking_fit"}


@pytest.fixture(scope="module")
def database():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - LONG_FITS))
def test_query_matches_sql(spark, database, name):
    assert difference(spark, database, entry.queries()[name], entry.oracle_sql()[name], DIRECTORY) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())
