"""Every query against its SQL on the smallest tables."""

import pytest

from skylattice.plans import oracle, registry
from tests.compare import differences

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = registry(), oracle()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert differences(df, FOLDER, SQL[name]) is None
    else:
        assert df.count() > 0


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)
