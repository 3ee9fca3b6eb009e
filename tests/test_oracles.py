import pytest

from oracle import connection, differences
from sheaf.plans import catalog


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, con, name):
    df = catalog.QUERIES[name](spark, sf)
    if name not in catalog.ORACLES:
        assert df.count() > 0
        return
    more, less = differences(df, con, catalog.ORACLES[name])
    assert not more and not less, (sum(more.values()), sum(less.values()), list(more)[:3], list(less)[:3])
