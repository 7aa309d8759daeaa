"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_util import compare, duck

ORACLES = E.oracle_sql()
NAMES = sorted(ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dk = duck(ORACLES[name], SF_SMALL)
    r = compare(sp, dk)
    assert r["ok"], r


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4 and set(df.columns) == {"brand_tier", "n_listings", "avg_price", "avg_car_age",
                                                  "damaged_share"}
