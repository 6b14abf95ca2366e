"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os

import pytest

from tessera.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf001):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    return con


def plain(value):
    if value is None or value != value:
        return None
    return float(value) if hasattr(value, "__float__") and not isinstance(value, (bool, str)) else value


def rows(pdf):
    cols = sorted(pdf.columns)
    return sorted(([plain(v) for v in r] for r in pdf[cols].astype(object).where(pdf[cols].notna(), None).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_against_sql(spark, sf001, duck, name):
    got, want = catalogue.QUERIES[name](spark, sf001).toPandas(), duck.execute(catalogue.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert all(p == q or (isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, abs_tol=2e-6)) for p, q in zip(x, y, strict=True)), (x, y)


def test_entry(spark):
    import __spark_entry__

    if os.path.isdir("/root/testdata/sf0.001"):
        assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
