"""The derived raw tables with more airports than a smallint holds, against the SQL twins."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SOURCE = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SOURCE.is_dir(), reason="no driver tables")


@pytest.fixture(scope="module")
def wide(tmp_path_factory):
    """The small tables, half of the events moved to users beyond 32,767; a connection that sees the same."""
    root, con = tmp_path_factory.mktemp("wide"), duckdb.connect()
    for f in SOURCE.glob("*.parquet"):
        user = "user_id + 33000 * (event_id % 2)"
        moved = f" REPLACE ({user} AS user_id)" if f.name == "events.parquet" else ""
        con.execute(f"COPY (SELECT *{moved} FROM '{f}') TO '{root}/{f.name}' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {f.name[:-8]} AS SELECT * FROM '{root}/{f.name}'")
    return str(root), con


def same(spark, wide, name):
    rel, df = wide[1].sql(entry.oracle_sql()[name]), entry.queries()[name](spark, wide[0])
    order = [rel.columns.index(c) for c in df.columns]
    want = Counter(tuple(r[i] for i in order) for r in rel.fetchall())
    assert sum(want.values()) > 0 and Counter(map(tuple, df.collect())) == want


@pytest.mark.parametrize("name", ["clean_flights", "allowed_keys", "colocated_flights", "enrich_zone_shift", "enrich_hot_instants"])
def test_airports_beyond_a_smallint(spark, wide, name):
    same(spark, wide, name)


@pytest.mark.parametrize("name", ["quality_exact", "quality_approx"])
def test_reports_count_airports_beyond_a_smallint(spark, wide, name):
    same(spark, wide, name)


def test_the_jobs_reports_count_airports_beyond_a_smallint(spark, wide):
    same(spark, wide, "pipeline_reports")
