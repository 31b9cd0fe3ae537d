"""Every registered query against its DuckDB oracle (the driver's correctness gate), on the smallest data."""

import datetime as dt
import decimal
import math
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry_mod
from sluice.plans.oracle import ORACLE
from sluice.plans.registry import QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import type_family  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if v is None:
        return "<NULL>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns[:2] == ["table_name", "check_name"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLE[name])
    o_cols, o_rows = _canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows
    s_types = {f.name: type_family(spark_type=f.dataType.simpleString()) for f in df.schema.fields}
    o_types = {d[0]: type_family(duck_type=str(d[1])) for d in cur.description}
    assert s_types == o_types
