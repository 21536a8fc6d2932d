"""Every registered graph and mapping query against its SQL, on the small tables."""

import pytest

from stelae.plans import registry
from tests.conftest import rows_of

NAMES = sorted(registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(name, spark, small, oracle):
    got = rows_of(registry.queries()[name](spark, small).toPandas())
    want = rows_of(oracle.execute(registry.oracle_sql()[name]).fetchdf())
    assert got == want
