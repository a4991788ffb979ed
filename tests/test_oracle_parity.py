"""Every registered query with an oracle equals its DuckDB SQL on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlens.sources.tables import TABLE_NAMES
from tools.check_oracle import digest

from .conftest import SF_SMALL

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    import tempfile
    c = duckdb.connect()
    c.execute(f"SET temp_directory = '{tempfile.mkdtemp(prefix='duck-', dir='/tmp')}'")
    c.execute("SET max_temp_directory_size = '4GB'")
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_a_callable():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_parity(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "TARGET" in df.columns
