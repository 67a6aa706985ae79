"""Every named query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tillstream import catalog, session
from tests.compare import differences, oracle

SF = "/root/testdata/sf0.001"
# Nothing to find in tables this small: equal and empty on both sides.
EMPTY_HERE = {"duplicate_keys_composite", "patch_skus_refused"}


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


def test_contract_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "item_count" in df.columns


@pytest.mark.parametrize("name", sorted(catalog.entries()))
def test_query(spark, con, name):
    diff = differences(spark, con, name, SF)
    session.discard(spark)
    assert diff is None or (name in EMPTY_HERE and diff.startswith("no rows")), diff
