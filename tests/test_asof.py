"""The as-of join against a plain-Python brute force, on ties, NULLs, exact bounds, hot keys, instants, copies."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from asofkit.operators import asof
from asofkit.operators.asof import asof_lags
from asofkit.operators.intervals import interval_join

T0 = datetime(2024, 1, 1)
LEFT = "id int, k int, t timestamp_ntz"
RIGHT = "k int, w timestamp_ntz, tie int, v int"


def expected(left, right, hours, lags):
    out = Counter()
    for i, k, t in left:
        near = [] if k is None or t is None else [
            (w, tie, v) for rk, w, tie, v in right
            if rk == k and w is not None and t - timedelta(hours=hours) <= w <= t
        ]
        near.sort(reverse=True)
        out[(i, k, t, tuple((w, v) for w, tie, v in near[: max(lags, 1)]))] += 1
    return out


def actual(df, lags):
    def one(r):
        found = r["m"] if lags else ([r["m"]] if r["m"] is not None else [])
        return r["id"], r["k"], r["t"], tuple((x["w_ts"], x["v"]) for x in found)
    return Counter(one(r) for r in df.collect())


def frames(spark, left, right, partitions=3):
    return (spark.createDataFrame(left, LEFT).repartition(partitions),
            spark.createDataFrame(right, RIGHT).repartition(partitions))


def run(spark, left, right, hours=12, lags=3, **kw):
    lf, rf = frames(spark, left, right)
    return asof_lags(lf, rf, by="k", left_ts="t", right_ts="w", tolerance_hours=hours, lags=lags,
                     payload=["v"], tie_break=["tie"], out="m", **kw)


def random_case(seed, keys, n=160, span=60, unit_hours=1):
    rnd = random.Random(seed)
    def key():
        return None if rnd.random() < 0.07 else rnd.randrange(keys)
    def time():
        return None if rnd.random() < 0.07 else T0 + timedelta(hours=rnd.randrange(span) * unit_hours)
    left = [(i, key(), time()) for i in range(n)]
    right = [(key(), time(), rnd.randrange(3), i) for i in range(n)]
    return left, right


@pytest.mark.parametrize("lags", [0, 1, 3, 7])
@pytest.mark.parametrize("keys", [1, 5])
@pytest.mark.parametrize("segment_rows", [10_000, 20])
def test_matches_brute_force(spark, lags, keys, segment_rows):
    left, right = random_case(lags * 10 + keys, keys)
    got = run(spark, left, right, lags=lags, segment_rows=segment_rows, max_pieces=40)
    assert actual(got, lags) == expected(left, right, 12, lags)


@pytest.mark.parametrize("hours", [0, 2])
def test_dense_segments_shorter_than_tolerance(spark, hours):
    rnd = random.Random(5)
    left = [(i, 0, T0 + timedelta(seconds=rnd.randrange(4000))) for i in range(300)]
    right = [(0, T0 + timedelta(seconds=rnd.randrange(4000)), 0, i) for i in range(300)]
    got = run(spark, left, right, hours=hours, lags=5, segment_rows=10, max_pieces=100)
    assert actual(got, 5) == expected(left, right, hours, 5)


def test_hot_instant_and_copies(spark):
    """A third of both sides at one instant of one key, most of them exact copies."""
    rnd = random.Random(9)
    hot = T0 + timedelta(hours=20)
    left = [(7, 0, hot)] * 100 + [(8, 0, hot)] * 20
    left += [(100 + i, rnd.randrange(3), T0 + timedelta(hours=rnd.randrange(50))) for i in range(200)]
    right = [(0, hot, i % 2, 5) for i in range(100)] + [(0, hot, 3, i) for i in range(9)]
    right += [(rnd.randrange(3), T0 + timedelta(hours=rnd.randrange(50)), 0, i) for i in range(200)]
    for lags in (0, 4, 12):
        got = run(spark, left, right, lags=lags, segment_rows=25, max_pieces=60)
        assert actual(got, lags) == expected(left, right, 12, lags)


def test_hot_rows_without_key_are_spread(spark):
    left = [(1, None, T0)] * 300 + [(2, 0, None)] * 100 + [(3, 0, T0)]
    right = [(0, T0, 0, 1), (None, T0, 0, 2)]
    got = run(spark, left, right, segment_rows=50)
    assert actual(got, 3) == expected(left, right, 12, 3)


def test_splits_are_bounded_and_cut_only_hot_keys(spark):
    points = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("_k0"),
        F.when(F.col("id") % 6 == 0, F.lit(1)).otherwise(F.col("id")).alias("_t"),
    )
    s = asof.find_splits(points, ["_k0"], segment_rows=500, max_pieces=32)
    rows = s.frame.collect()
    assert [r["_k0"] for r in rows] == [0]
    assert 8 <= sum(rows[0]["_mult"]) <= 14  # about a third of 32
    assert s.has_instants and max(rows[0]["_mult"]) >= 4
    assert asof.find_splits(points, ["_k0"], segment_rows=20_000, max_pieces=32) is None


def test_no_group_of_a_split_plan_holds_a_hot_key(spark, monkeypatch):
    """Look at the rows before the window: no (key, segment, salt) holds more than a few pieces' worth."""
    seen = {}
    plain = asof._look_back

    def spy(rows, keys, n):
        seen["last"] = rows
        return plain(rows, keys, n)

    monkeypatch.setattr(asof, "_look_back", spy)
    hot = T0 + timedelta(hours=20)
    left = [(7, 0, hot)] * 1000 + [(i, 0, T0 + timedelta(minutes=i)) for i in range(1000)] + [(1, None, T0)] * 1000
    right = [(0, hot, 0, 1)] * 1000 + [(0, T0 + timedelta(minutes=i), 0, i) for i in range(1000)]
    lf = spark.createDataFrame(left, LEFT).repartition(40)
    rf = spark.createDataFrame(right, RIGHT).repartition(40)
    got = asof_lags(lf, rf, by="k", left_ts="t", right_ts="w", lags=3, payload=["v"], tie_break=["tie"], out="m",
                    segment_rows=50, max_pieces=50)
    assert got.count() == len(left)
    biggest = seen["last"].groupBy("_k0", "_seg", "_salt").count().agg(F.max("count")).first()[0]
    assert biggest < 500


def test_empty_sides(spark):
    left, right = random_case(3, 2, n=20)
    assert actual(run(spark, left, []), 3) == expected(left, [], 12, 3)
    assert run(spark, [], right).count() == 0


def test_legacy_unmatched_and_unbounded(spark):
    left, right = [(1, 0, T0)], [(0, T0 - timedelta(days=90), 0, 4)]
    [row] = run(spark, left, right, legacy_unmatched=True).collect()
    assert len(row["m"]) == 1 and row["m"][0]["w_ts"] is None
    [row] = run(spark, left, right, lags=0, legacy_unmatched=True).collect()
    assert row["m"] is not None and row["m"]["v"] is None
    [row] = run(spark, left, right, hours=None).collect()
    assert [x["v"] for x in row["m"]] == [4]
    with pytest.raises(ValueError):
        run(spark, left, right, lags=-1)


def test_zoned_timestamps_and_two_keys(spark):
    left = spark.createDataFrame([(1, "a", 1, T0)], "id int, x string, y int, t timestamp")
    right = spark.createDataFrame(
        [("a", 1, T0 - timedelta(hours=1), 1), ("a", 2, T0, 2), ("b", 1, T0, 3)],
        "x string, y2 int, w timestamp, v int")
    got = asof_lags(left, right, by=["x", "y"], right_by=["x", "y2"], left_ts="t", right_ts="w", lags=2, out="m")
    [row] = got.collect()
    assert [(m["w_ts"], m["v"]) for m in row["m"]] == [(T0 - timedelta(hours=1), 1)]


def test_same_under_other_partitioning(spark):
    left, right = random_case(11, 2)
    results = []
    for n, segment_rows in (("3", 10_000), ("13", 10_000), ("3", 15)):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(actual(run(spark, left[::-1], right, lags=5, segment_rows=segment_rows, max_pieces=30), 5))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("segment_rows", [10_000, 20])
def test_wall_clock_in_a_dst_gap(spark, segment_rows):
    """Zoneless times keep their order whatever the session zone: 02:30 does not exist in this one."""
    rnd = random.Random(4)
    gap = datetime(2012, 3, 11, 1)
    left = [(i, 0, gap + timedelta(minutes=rnd.randrange(180))) for i in range(120)]
    right = [(0, gap + timedelta(minutes=rnd.randrange(180)), 0, i) for i in range(120)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = actual(run(spark, left, right, hours=1, segment_rows=segment_rows, max_pieces=30), 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == expected(left, right, 1, 3)


def test_one_shuffle_when_small(spark):
    left, right = random_case(1, 3, n=20)
    plan = run(spark, left, right)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("hashpartitioning") == 1 and "Join" not in physical


@pytest.mark.parametrize("seed,keys", [(1, 1), (2, 4)])
def test_interval_join_matches_brute_force(spark, seed, keys):
    left, right = random_case(seed, keys, n=80)
    lf, rf = frames(spark, left, right)
    got = interval_join(lf, rf, by="k", left_ts="t", right_ts="w", hours=6)
    plan = got._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "Window" not in physical and physical.count("Scan") == 2 and physical.count("Join") == 1
    want = Counter()
    for i, k, t in left:
        near = [] if k is None or t is None else [
            (w, tie, v) for rk, w, tie, v in right
            if rk == k and w is not None and t - timedelta(hours=6) <= w <= t]
        for w, tie, v in near or [(None, None, None)]:
            want[(i, k, t, w, tie, v)] += 1
    assert Counter(tuple(r[c] for c in ("id", "k", "t", "w", "tie", "v")) for r in got.collect()) == want


@pytest.mark.parametrize("partitions", ["8", "200"])
def test_segments_stay_near_segment_rows(spark, partitions):
    """One key holds all rows: how far it is cut follows from the rows alone, not from the session."""
    from pyspark.sql import functions as F

    from asofkit.operators.asof import _segmented, find_splits

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        points = spark.range(20_000).select(F.lit(1).alias("_k0"), F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("_t"))
        splits = find_splits(points, ["_k0"], segment_rows=10, max_pieces=None)
        assert splits.pieces == 2_000 and splits.most_cuts > 1_000
        largest = _segmented(points, ["_k0"], splits).groupBy("_seg").count().agg(F.max("count")).first()[0]
        assert largest <= 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("partitions", ["8", "200"])
def test_hot_enrichment_is_cut(spark, partitions):
    """The frames that enrich_hot and enrich_hot_instants cut, flights and weather, under any number of shuffle partitions."""
    from asofkit.checks.queries import folded_to_months
    from asofkit.checks.standins import raw_flights, raw_stations, raw_weather
    from asofkit.operators.asof import _keyed, find_splits
    from asofkit.plans import cleaning
    from asofkit.plans.enrich import with_arrival

    d, before = "/root/testdata/sf0.001", spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        flights = cleaning.clean_flights(raw_flights(spark, d))
        weather = cleaning.clean_weather(raw_weather(spark, d), cleaning.clean_station_map(raw_stations(spark, d)), flights)
        for fold in (False, True):
            f, w = folded_to_months(flights, weather) if fold else (flights, weather)
            for key, ts in (("ORIGIN_AIRPORT_ID", "CRS_DEP_TIMESTAMP"), ("DEST_AIRPORT_ID", "CRS_ARR_TIMESTAMP")):
                points = _keyed(with_arrival(f), [key], ts).select("_k0", "_t").unionByName(_keyed(w, ["AirportId"], "timestamp").select("_k0", "_t"))
                splits = find_splits(points, ["_k0"], segment_rows=20, max_pieces=None)
                assert splits.most_cuts > 0
                assert splits.has_instants or not (fold and ts == "CRS_DEP_TIMESTAMP")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_deep_index_of_cuts(spark, threshold):
    """A key with thousands of cuts beside small ones: three levels, broadcast or joined by shuffle, place rows as the whole list would."""
    from bisect import bisect_right

    from pyspark.sql import functions as F

    from asofkit.operators import asof

    before, fan = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), asof.FAN
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    asof.FAN = 8
    try:
        points = spark.range(6_000).select(
            F.when(F.col("id") % 5 > 0, 0).when(F.col("id") % 50 == 0, 2).when(F.col("id") % 55 > 0, 1).alias("_k0"),
            F.when(F.col("id") % 977 > 0, F.timestamp_seconds(F.when(F.col("id") < 1_000, 500).otherwise(F.col("id")))).cast("timestamp_ntz").alias("_t"))
        splits = asof.find_splits(points, ["_k0"], segment_rows=25, max_pieces=None)
        assert len(splits.index) == 3 and splits.has_instants
        cuts = {r["_k0"]: (r["_cuts"], r["_mult"]) for r in splits.frame.collect()}
        placed = asof._segmented(points, ["_k0"], splits).collect()
        assert len(placed) == 6_000
        for r in placed:
            c, m = cuts.get(r["_k0"], ([], []))
            at = bisect_right(c, r["_t"]) if r["_t"] and r["_k0"] is not None else 0
            deal = m[at - 1] if at and c[at - 1] == r["_t"] and m[at - 1] > 1 else None
            assert (r["_seg"], r["_deal"]) == (at, deal)
            assert r["_end"] == (c[at] if r["_t"] and at < len(c) else None)
        plan = asof._segmented(points, ["_k0"], splits)._jdf.queryExecution().toString()
        physical = plan[plan.index("== Physical Plan =="):]
        # Only heavy roots are broadcast whatever the threshold.
        assert physical.count("BroadcastHashJoin") == (1 if threshold == "-1" else 3)
    finally:
        asof.FAN = fan
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("lags", [0, 4])
def test_carry_of_many_segments_is_found_in_blocks(spark, monkeypatch, lags):
    """One key in over a thousand segments, some instants of which are hot: no group of the carry's search holds them all."""
    biggest, plain = [], asof._look_back

    def spy(rows, keys, n):
        biggest.append(rows.groupBy(*keys, "_seg", "_salt").count().agg(F.max("count")).first()[0])
        return plain(rows, keys, n)

    monkeypatch.setattr(asof, "_look_back", spy)
    monkeypatch.setattr(asof, "BLOCK", 32, raising=False)
    rnd = random.Random(3)

    def time():
        return T0 + timedelta(minutes=rnd.choice((rnd.randrange(6000), 3000, 3001, 5900)) if rnd.random() < 0.1 else rnd.randrange(6000))

    left, right = [(i, 0, time()) for i in range(1500)], [(0, time(), rnd.randrange(3), i) for i in range(1500)]
    got = run(spark, left, right, hours=12, lags=lags, segment_rows=2)
    assert actual(got, lags) == expected(left, right, 12, lags)
    assert max(biggest) < 40 * (max(lags, 1) + 2)


def test_cuts_and_their_sample_are_bounded(spark, monkeypatch):
    """However short the segments asked for, the driver gets a bounded number of cuts."""
    points = spark.range(400_000).select(F.lit(0).alias("_k0"), F.col("id").alias("_t"))
    s = asof.find_splits(points, ["_k0"], segment_rows=1, max_pieces=None)
    assert 100_000 < s.most_cuts < 150_000
    frames, of = [], type(points).sample
    monkeypatch.setattr(type(points), "sample", lambda df, **kw: frames.append(of(df, **kw)) or frames[-1])
    monkeypatch.setattr(asof, "_MOST_POINTS", 50_000, raising=False)
    monkeypatch.setattr(asof, "MOST_PIECES", 2_000, raising=False)
    s = asof.find_splits(points, ["_k0"], segment_rows=1, max_pieces=None)
    assert 1_500 < s.most_cuts <= 2_500 and frames[0].count() < 60_000
