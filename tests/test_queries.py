"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_registered_before_any_session_and_named_alike():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-6, abs_tol=2e-6)
    return a == b


def key(row):
    return tuple((v is not None, f"{v + 0.0:.4g}" if isinstance(v, float) else str(v)) for v in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    rows = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
    if name not in entry.oracle_sql():
        assert rows
        return
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    want = sorted(rel.select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall(), key=key)
    assert len(rows) == len(want)
    bad = [(a, b) for a, b in zip(rows, want) if not all(map(close, a, b))]
    assert not bad, bad[:3]
