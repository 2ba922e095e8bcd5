"""Every registered query with an oracle equals DuckDB on the same tables (sf0.001)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_SMALL, duck
from tests.helpers import canon

NAMES = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    assert canon(got) == canon(want)


def test_every_query_runs(spark):
    for name, fn in queries().items():
        if name in oracle_sql():
            continue
        df = fn(spark, SF_SMALL)
        assert df.count() >= 1, name


def test_entry_schema_stable(spark):
    a = entry(spark)
    b = entry(spark)
    assert a.schema == b.schema
    assert a.count() == 15
