"""Every registered query against its DuckDB twin on the smallest scale factor."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from fuelsight.plans.catalog import QUERIES


SQL = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}
SPARK_TO_DUCK = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return ("f", float("%.12g" % v)) if not math.isnan(v) else ("f", "nan")
    if v is None:
        return ("n", "")
    if hasattr(v, "isoformat"):
        return ("t", v.isoformat())
    return ("s", str(v))


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _rows([r.asDict() for r in df.collect()], cols)
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    assert {f.name: SPARK_TO_DUCK[f.dataType.simpleString()] for f in df.schema.fields} == \
        {d[0]: str(d[1]) for d in res.description}
    want = _rows([dict(zip(dcols, r)) for r in res.fetchall()], cols)
    assert len(got) == len(want)
    assert got == want


def test_every_query_has_a_builder_and_an_oracle():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(QUERIES) <= set(sql)  # the optional corpus operators have a twin only where SQL expresses them


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["vin", "now_date", "data_key", "data_value"]
    assert df.count() > 0
