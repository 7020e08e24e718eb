"""Every registered query with a SQL counterpart gives its rows on the smallest driver tables."""

import pytest

from corundum.plans.registry import ORACLES, QUERIES
from tests.oracle import same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    same(spark, SF, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() > 0


def test_names_agree():
    assert set(ORACLES) <= set(QUERIES)
