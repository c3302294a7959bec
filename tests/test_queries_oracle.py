"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from veilspark.plans import catalog

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


# The text operators have tests of their own in tests/llm.
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    if name not in ORACLES:
        assert len(rows) > 0
        return
    res = duck.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(rows, df.columns) == _rows(drows, dcols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["rank", "word", "i", "released"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_registers_all_of_them():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
