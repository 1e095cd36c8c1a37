"""Every SQL twin gives the same rows as its query over the smallest tables."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

from ledgerline.plans import catalog

SF = "/root/testdata/sf0.001"
ORACLES = catalog.oracle_sql()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((str(k), plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def ordered(columns, rows):
    at = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in at], sorted((tuple(plain(r[k]) for k in at) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for f in sorted(Path(SF).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_and_sql_agree(spark, duck, name):
    found = catalog.queries()[name](spark, SF)
    ours = ordered(found.columns, [tuple(r) for r in found.collect()])
    there = duck.sql(ORACLES[name])
    assert ours == ordered(there.columns, there.fetchall())


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(catalog.queries())
