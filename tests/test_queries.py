"""Every catalogued query against its oracle in DuckDB on the smallest tables."""

import duckdb
import pytest

from ledgerleaf.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), duck.execute(catalog.ORACLES[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda df: sorted(df[cols].astype(str).itertuples(index=False, name=None))
    assert key(got) == key(want)
