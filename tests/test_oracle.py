"""Every registered query equals its DuckDB twin (row count, columns, values)."""

import duckdb
import pytest

from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _keys():
    from flightlake.catalog import QUERIES
    from flightlake.oracle import ORACLE_SQL
    return sorted(QUERIES), ORACLE_SQL


KEYS, SQL = _keys()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(KEYS) == set(SQL)


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_duckdb(spark, duck, name):
    from __spark_entry__ import queries
    from tools.oracle_check import digest

    df = queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows, df.columns)[0] == digest(drows, dcols)[0]


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["flight_iata", "idx", "lat", "lon", "t", "risk", "band"]
    assert df.count() == 1572  # scheduled flights with resolved airports, 4 points each
