"""Every registered query of the engine against its SQL in DuckDB."""

from pathlib import Path

import duckdb
import pytest

from tidemark.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents pages conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{Path(sf_dir) / t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return float(v) if type(v).__name__ == "Decimal" else str(v) if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(str(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    cur = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(str(tuple(plain(r[names.index(c)]) for c in cols)) for r in cur.fetchall())
    assert got == want


def test_entry_imports(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).limit(1).count() == 1
