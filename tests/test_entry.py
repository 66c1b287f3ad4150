"""Every query against its SQL, on the tables of the correctness run."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(values):
    """Rows in an order that doesn't hang on the last digits of floats."""
    plain = [tuple(float(v) if type(v).__name__ == "Decimal" else v for v in r) for r in values]
    return sorted(plain, key=lambda r: tuple(("" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v)) for v in sorted(r, key=lambda v: isinstance(v, float))))


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, con, name):
    want = con.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, SF)
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    a = rows(tuple(r) for r in got.select(*(f"`{c}`" for c in order)).collect())
    b = rows(want.select(", ".join(f'"{c}"' for c in order)).fetchall())
    assert len(a) == len(b)
    assert all(same(x, y) for r, s in zip(a, b, strict=True) for x, y in zip(r, s, strict=True))


def test_every_query_is_named_once():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) >= 70
