"""Month tables, co-located tables, measures taken while writing, quarantine of broken lines: files and plans."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from asofkit.operators.reducing import restrict_to
from asofkit.plans.enrich import Seen, flight_measures, measured, with_arrival
from asofkit.sources import tables


def physical(df):
    plan = df._jdf.queryExecution().toString()
    return plan[plan.index("== Physical Plan =="):]


@pytest.fixture
def days(spark):
    return spark.range(400).select("id", F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("2023-11-15 07:30:00").cast("timestamp_ntz")).alias("t"))


def test_months_are_replaced_one_by_one(spark, days, tmp_path):
    path = f"{tmp_path}/t"
    for month in ("202312", "202311", "202401"):
        tables.write_months(days.where(F.date_format("t", "yyyyMM") == month), path, "t")
    tables.write_months(days.where("id < 3").withColumn("id", F.col("id") + 1_000), path, "t")
    got = {(r.id, r.month) for r in tables.read_months(spark, path).collect()}
    assert {r for r in got if r[1] == "202311"} == {(1_000, "202311"), (1_001, "202311"), (1_002, "202311")}
    assert len(got) == 3 + 31 + 31
    tables.write_months(spark.createDataFrame([(7, None)], "id long, t timestamp_ntz"), path, "t")  # no day
    assert {(r.id, r.t) for r in tables.read_months(spark, path).where("id = 7").collect()} >= {(7, None)}


def test_bounds_prune_months_and_files(spark, days, tmp_path):
    path = f"{tmp_path}/t"
    tables.write_months(days, path, "t")
    low, high = datetime(2024, 2, 10), datetime(2024, 4, 3, 7, 30)
    df = tables.read_months_within(spark, path, "t", (low, high))
    assert {r.t for r in df.collect()} == {r.t for r in days.collect() if low <= r.t <= high}
    part, pushed = physical(df).split("PartitionFilters: [")[1].split("]")[0], physical(df).split("PushedFilters: [")[1].split("]")[0]
    assert "202402" in part and "202404" in part and "GreaterThanOrEqual(t" in pushed
    read = tables.read_months(spark, path, first="202402", last="202404").select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("month=")[1][:6] for r in read} == {"202402", "202403", "202404"}
    assert tables.read_months_within(spark, path, "t", None).count() == 0


def test_month_table_in_the_catalog(spark, days, tmp_path):
    path = f"{tmp_path}/t"
    tables.write_months(days.where("id < 30"), path, "t")
    tables.register_months(spark, "storage_test", "days", path)
    assert spark.table("storage_test.days").count() == 30
    tables.write_months(days.where("id >= 30"), path, "t")  # December again, from the 30th day on, and later months
    tables.register_months(spark, "storage_test", "days", path)
    names = {r[0] for r in spark.sql("SHOW PARTITIONS storage_test.days").collect()}
    assert len(names) == 14 and spark.table("storage_test.days").count() == 16 + 370
    spark.sql("DROP DATABASE storage_test CASCADE")


def test_colocated_tables_meet_without_an_exchange(spark, days):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = tables.write_colocated(days.withColumn("k", F.col("id") % 50), "colocated_left", "k", 4, ["t"])
        right = tables.write_colocated(days.where("id < 20").withColumnRenamed("id", "k"), "colocated_right", "k", 4, ["t"])
        both = restrict_to(left, right, "k")
        assert "Exchange" not in physical(both) and both.count() == 160
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS colocated_left")
        spark.sql("DROP TABLE IF EXISTS colocated_right")


def test_measures_while_writing_equal_those_of_a_pass(spark, tmp_path):
    flights = spark.createDataFrame(
        [(datetime(2024, 1, 1, h), e) for h, e in ((3, 60.0), (9, 9_000.0), (5, None), (2, -300.0))] + [(None, 5.0)],
        "CRS_DEP_TIMESTAMP timestamp_ntz, CRS_ELAPSED_TIME float")
    columns = {"FL_DATE": "date", "ORIGIN_AIRPORT_ID": "int", "DEST_AIRPORT_ID": "int", "ARR_DELAY_NEW": "float"}
    flights = flights.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})
    seen = tables.write_measured(flights, f"{tmp_path}/f", flight_measures() | {"rows": F.count(F.lit(1))})
    weather = spark.range(3)
    assert measured(with_arrival(flights), weather) == Seen(seen["rows"], 3, seen["first"], seen["last"])
    assert (seen["first"], seen["last"]) == (datetime(2023, 12, 31, 21), datetime(2024, 1, 7, 15))
    none = tables.write_measured(flights.where("false"), f"{tmp_path}/g", flight_measures() | {"rows": F.count(F.lit(1))})
    assert (none["rows"], none["first"]) == (0, None)


def test_broken_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y,z\n1,2,3\n4,5\n"a,b",,c\n6,7,8,9\n\n')
    (tmp_path / "b.csv").write_text("x,y,z\n10,11,12\nlonely\n")
    good, broken = tables.read_checked_text(spark, f"{tmp_path}/*.csv")
    assert {tuple(r) for r in good.collect()} == {("1", "2", "3"), ("a,b", None, "c"), ("10", "11", "12")}
    assert {(r.file[-5:], r.line) for r in broken.collect()} == {("a.csv", "4,5"), ("a.csv", "6,7,8,9"), ("b.csv", "lonely")}
    assert (good.count(), broken.count()) == (3, 3)
    assert good.select("y").where("y = '5'").count() == 0 and broken.groupBy("file").count().count() == 2


def test_weather_in_reach_is_less_and_enough(spark):
    from asofkit.checks.standins import raw_flights, raw_stations, raw_weather
    from asofkit.plans import cleaning

    d = "/root/testdata/sf0.001"
    flights, stations = cleaning.clean_flights(raw_flights(spark, d)), cleaning.clean_station_map(raw_stations(spark, d))
    whole, near = (cleaning.clean_weather(raw_weather(spark, d), stations, flights, look_back_hours=h) for h in (None, 12))
    kept = near.select("AirportId", "WBAN", "timestamp", "WindSpeed")
    assert near.columns == whole.columns and 0 < near.count() < whole.count() / 2
    assert kept.exceptAll(whole.select(*kept.columns)).count() == 0
    # nothing that a flight can see is missing
    lost = whole.select(*kept.columns).exceptAll(kept)
    timed = with_arrival(flights)
    for key, ts in (("ORIGIN_AIRPORT_ID", "CRS_DEP_TIMESTAMP"), ("DEST_AIRPORT_ID", "CRS_ARR_TIMESTAMP")):
        seen = lost.join(timed, (lost["AirportId"] == timed[key]) & lost["timestamp"].between(timed[ts] - F.expr("INTERVAL 12 HOURS"), timed[ts]), "left_semi")
        assert seen.count() == 0
