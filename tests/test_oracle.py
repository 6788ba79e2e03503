import pytest

from oracle import assert_matches
from touchline.plans import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, name):
    rows = assert_matches(registry.QUERIES[name](spark, SF_DIR), registry.ORACLES[name], SF_DIR)
    assert rows > 0


def test_every_oracle_has_a_query():
    assert set(registry.ORACLES) <= set(registry.QUERIES)
