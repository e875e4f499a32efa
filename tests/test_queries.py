"""Every query of the log jobs against its SQL on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from sparklogs import io_queries, queries  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def rows(columns, found):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in found), columns


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, sf, name):
    df = queries.QUERIES[name](spark, sf)
    names = sorted(df.columns)
    got = rows(names, df.select(*[f"`{n}`" for n in names]).collect())
    if name not in queries.SQL:
        assert got[0]
        return
    found = duck.sql(queries.SQL[name])
    assert sorted(found.columns) == names
    expected = rows(names, duck.sql(f"SELECT {', '.join(f'"{n}"' for n in names)} FROM ({queries.SQL[name]}) q").fetchall())
    assert got == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(entry.queries())


def test_entry_without_a_library():
    """Where a library that only the training data needs is missing, the log queries are there."""
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; q = e.queries(); assert 'group_stats' in q and not [n for n in q if n.startswith('op')]; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.abspath(entry.__file__)))
