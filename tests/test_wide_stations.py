"""The quality reports over customers, and so airports and stations, with ids of any size, against the SQL twins and counts by hand."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

# ids that fit a smallint, that fit none, and whose stations fit no int
STARTS = (0, 33_000, 2**31 - 30_000, 5_000_000_000)


@pytest.fixture(scope="module")
def wide(tmp_path_factory):
    """Sixty customers from each start on and one without id, events at the first twenty of each; a connection that sees the same."""
    root, con = tmp_path_factory.mktemp("stations"), duckdb.connect()
    starts = f"unnest({list(STARTS)}::BIGINT[])"
    made = {
        "customer": f"SELECT s + i AS c_custkey, (i % 25)::INTEGER AS c_nationkey FROM (SELECT {starts} AS s), range(60) r(i) UNION ALL SELECT NULL, 3",
        "events": f"SELECT i AS event_id, TIMESTAMP '2024-01-01 00:30:00' + to_hours((i % 200)::INTEGER) AS ts, ({list(STARTS)}::BIGINT[])[i // 7 % 4 + 1] + i // 28 % 20 AS user_id,"
                  " CASE WHEN i % 3 = 0 THEN 'purchase' ELSE 'view' END AS event_type, (i % 90)::DOUBLE AS value FROM range(2400) r(i)",
    }
    for name, rows in made.items():
        con.execute(f"COPY ({rows}) TO '{root}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return str(root), con


def report(spark, wide, name):
    """The query's rows by dataset; they equal the SQL's."""
    rel, rows = wide[1].sql(entry.oracle_sql()[name]), entry.queries()[name](spark, wide[0]).collect()
    assert Counter(tuple(r[c] for c in rel.columns) for r in rows) == Counter(rel.fetchall())
    return {r["dataset"]: r for r in rows}


@pytest.mark.parametrize("name", ["quality_approx", "quality_exact"])
def test_reports_count_all_stations(spark, wide, name):
    got = report(spark, wide, name)
    stations, weather = got["airport_timezone_clean"], got["weather_clean"]
    customers = {s + i for s in STARTS for i in range(60)}
    pairs = {(c, 10_000 + c) for c in customers} | {(c, 50_000 + c) for c in customers if c % 3 == 0} | {(c + 1, 10_000 + c) for c in customers if c % 25 == 0}
    assert (stations["rows"], stations["distinct_AirportId"], stations["distinct_WBAN"]) == (len(pairs), len({a for a, _ in pairs}), len({w for _, w in pairs}))
    assert weather["distinct_AirportId"] >= 20 * len(STARTS)
