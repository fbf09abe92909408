"""Every core query with a DuckDB equivalent gives the same rows; the entry module needs no session."""

import math
import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

from paperloom.plans import queries as core


@pytest.fixture(scope="session")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(data):
        path = f"{data}/{name}" + ("/*.parquet" if os.path.isdir(f"{data}/{name}") else "")
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    return round(float(v), 6) if isinstance(v, (int, float)) or type(v).__name__ == "Decimal" else str(v)


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_query_equals_sql(spark, data, duck, name):
    df = core.queries()[name](spark, data)
    columns = sorted(df.columns)
    cursor = duck.execute(core.oracle_sql()[name])
    there = [c[0] for c in cursor.description]
    assert sorted(there) == columns
    at = [there.index(c) for c in columns]
    want = Counter(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
    assert Counter(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()) == want


@pytest.mark.parametrize("name", sorted(set(core.queries()) - set(core.oracle_sql())))
def test_query_runs(spark, data, name):
    df = core.queries()[name](spark, data)
    assert df.columns and df.count() >= 0


def test_entry_without_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q))"
    assert int(subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout) >= len(core.queries())
