"""Every query against its SQL in DuckDB, on the smallest tables."""

import decimal
from pathlib import Path

import duckdb
import pytest

from fieldglass import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in Path(FOLDER).glob("*.parquet"):
        c.sql(f"create view {f.stem} as select * from '{f}'")
    return c


def rows(values):
    plain = lambda v: float(v) if isinstance(v, (float, decimal.Decimal)) else v
    return sorted([tuple(plain(v) for v in r) for r in values], key=str)


@pytest.mark.parametrize("name", sorted(catalog.oracles()))
def test_same_rows(spark, duck, name):
    got = catalog.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    want = duck.sql(catalog.oracles()[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert rows(tuple(r[c] for c in columns) for r in got.collect()) == rows(tuple(r[i] for i in at) for r in want.fetchall())
