"""Every registered query with SQL against DuckDB on the same tables; the others give rows."""

import duckdb
import pytest
from framequery.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    got = sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())
    if name not in registry.ORACLE_SQL:
        assert got
        return
    q = duck.sql(registry.ORACLE_SQL[name])
    order = sorted(range(len(q.columns)), key=lambda k: q.columns[k])
    assert [q.columns[k] for k in order] == sorted(df.columns)
    assert got == sorted(tuple(str(r[k]) for k in order) for r in q.fetchall())
