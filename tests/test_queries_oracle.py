"""Every registered query against its DuckDB oracle on the smallest tables.

The same comparison the driver makes: columns sorted by name, row count,
column names and an order-insensitive hash of the values."""

import pytest

import __spark_entry__ as E
from scripts.oracle_check import digest

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_small):
    import duckdb
    from tidings.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_small, duck, name):
    df = QUERIES[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_runs(spark, sf_small, name):
    assert QUERIES[name](spark, sf_small).count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["msg_uid", "from_addr", "to_addr", "subject", "html", "original"]
