import pytest

import __spark_entry__ as E
from tests import oracle
from tests.conftest import SF_SMALL


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["database", "table", "column", "count_data", "count_valid", "percentage_valid", "data_invalid"]


def test_every_query_has_an_oracle():
    assert set(E.core_queries()) == set(E.core_oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    return oracle.duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(E.core_queries()))
def test_query_matches_oracle(spark, duck, key):
    ok, msg = oracle.compare(spark, duck, SF_SMALL, key, E.core_queries()[key], E.core_oracle_sql()[key])
    assert ok, msg
