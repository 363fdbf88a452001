"""Every query against its SQL twin in DuckDB, on the small driver tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = [f[: -len(".parquet")] for f in sorted(os.listdir(SF_DIR))] if os.path.isdir(SF_DIR) else []
pytestmark = pytest.mark.skipif(not TABLES, reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    rel = duck.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    sql_types = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    assert {c: sql_types[t] for c, t in df.dtypes} == dict(zip(rel.columns, map(str, rel.types)))
    order = [rel.columns.index(c) for c in columns]
    want = Counter(tuple(plain(r[i]) for i in order) for r in rel.fetchall())
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert sum(want.values()) > 0
    assert got == want, f"only Spark: {list((got - want).items())[:3]}\nonly SQL: {list((want - got).items())[:3]}"


def test_every_query_has_an_oracle():
    own = {q for q in entry.queries() if q not in entry.LLM_QUERIES and q != "pipeline"}
    assert own <= set(entry.oracle_sql())
