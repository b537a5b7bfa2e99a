"""Every registered query with SQL gives what the SQL gives."""

import datetime
import decimal

import duckdb
import pytest

from gridpulse.plans.oracles import ORACLES
from gridpulse.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "orders", "events", "part")


def norm(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    return v.isoformat() if isinstance(v, datetime.datetime) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cur = duck.execute(ORACLES[name])
    there = [c[0] for c in cur.description]
    assert sorted(there) == columns
    at = [there.index(c) for c in columns]
    want = sorted(tuple(norm(r[i]) for i in at) for r in cur.fetchall())
    assert sorted(tuple(norm(r[c]) for c in columns) for r in df.collect()) == want


@pytest.mark.parametrize("name", ["gr3_betweenness", "ml3_isolation_forest", "ml7_incremental_run"])
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
