"""Every query with a SQL oracle equals DuckDB on the same parquet."""

import duckdb
import pytest

import __spark_entry__ as E
from giftlens.sources.tables import TABLES
from tools.oracle_check import table_hash

from conftest import SMALL

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = [tuple(r) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert table_hash(srows, sdf.columns)[0] == table_hash(drows, dcols)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_amount" in df.columns
