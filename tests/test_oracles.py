"""Every registered key runs on sf0.001; keys with an oracle equal DuckDB exactly."""

from __future__ import annotations

import pytest

from tests.conftest import SMOKE_DIR
from tools.oracle_check import rows_multiset

import __spark_entry__ as entry

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()

_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                  "timestamp": "TIMESTAMP WITH TIME ZONE"}


def spark_type(dt) -> str:
    s = dt.simpleString()
    return _SPARK_TO_DUCK.get(s, s.upper())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SMOKE_DIR)
    cols = df.columns
    assert len(cols) == len(set(cols)), f"duplicate output columns in {key}: {cols}"
    rows = [tuple(r) for r in df.collect()]
    if key not in ORACLES:
        return
    res = duck.execute(ORACLES[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    rel = duck.sql(ORACLES[key])
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    spark_types = {f.name: spark_type(f.dataType) for f in df.schema.fields}
    assert spark_types == duck_types, key
    assert len(rows) == len(drows)
    assert rows_multiset(cols, rows) == rows_multiset(dcols, drows)


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["brand_name", "brand_category", "brand_type"]
    assert df.count() > 0
