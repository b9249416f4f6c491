"""Every registered query against its check SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, plain, rows_of, same_rows

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    cols, got = rows_of(QUERIES[name](spark, SF_DIR))
    cur = duck.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    same_rows(got, [tuple(plain(r[i]) for i in at) for r in cur.fetchall()])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() == 150
