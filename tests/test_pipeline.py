"""All stages on the raw fixtures, through files, against fixed expected rows."""

from dataclasses import replace
from datetime import datetime

import pytest

from asofkit import PipelineConfig, clean_flights, enrich, flat_features, run_pipeline
from asofkit.operators import asof
from asofkit.operators.intervals import time_bounds, within
from asofkit.plans import pipeline
from asofkit.plans.cleaning import allowed_stations, clean_station_map
from asofkit.sources import tables
from tests.raw import write_raw

# dry-bulb temperature tells the observations apart
DRY = {41.0: "w1", None: "w2", 42.0: "w3", 43.0: "w4", 44.0: "w5"}


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """The job run once in full for January, 7 lags, and its config."""
    root = tmp_path_factory.mktemp("job")
    write_raw(root)
    config = PipelineConfig(
        flights_dir=f"{root}/Flights", weather_dir=f"{root}/Weather", station_csv=f"{root}/stations.csv",
        out_root=f"{root}/out", sample_month="201201", database="job_test", exact_quality=True, flat=True,
        month_report=True,
    )
    joined = run_pipeline(spark, config)
    return config, joined


def read(spark, path):
    return spark.read.parquet(path)


def test_flights(spark, made):
    df = read(spark, tables.TablePaths(made[0].out_root).flights)
    assert df.dtypes == [
        ("FL_DATE", "date"), ("OP_CARRIER", "string"), ("OP_CARRIER_FL_NUM", "smallint"),
        ("ORIGIN_AIRPORT_ID", "smallint"), ("DEST_AIRPORT_ID", "smallint"), ("CRS_DEP_TIME", "string"),
        ("CRS_ELAPSED_TIME", "float"), ("ARR_DELAY_NEW", "float"), ("WEATHER_DELAY", "float"),
        ("NAS_DELAY", "float"), ("HAS_WEATHER_DELAY", "boolean"), ("HAS_NAS_DELAY", "boolean"),
        ("CRS_DEP_TIMESTAMP", "timestamp_ntz")]
    rows = {r.OP_CARRIER_FL_NUM: r for r in df.collect()}
    assert sorted(rows) == [1, 2, 6, 7, 8, 1234]
    f1, f2 = rows[1], rows[2]
    assert (f1.CRS_DEP_TIMESTAMP, f1.WEATHER_DELAY, f1.HAS_WEATHER_DELAY) == (datetime(2012, 1, 1, 9, 5), 0.0, False)
    assert (f2.CRS_DEP_TIMESTAMP, f2.WEATHER_DELAY, f2.NAS_DELAY) == (datetime(2012, 1, 1, 0, 5), 15.0, 5.0)
    assert f2.HAS_WEATHER_DELAY and f2.HAS_NAS_DELAY and f2.CRS_DEP_TIME == "5"
    assert rows[6].CRS_DEP_TIMESTAMP is None and rows[7].CRS_ELAPSED_TIME is None


def test_flights_without_optional_columns(spark):
    raw = spark.createDataFrame(
        [("2012-01-01", "AA", "1", "2", "3", "0905", "95", "0")],
        "FL_DATE string, OP_CARRIER string, OP_CARRIER_FL_NUM string, ORIGIN_AIRPORT_ID string,"
        "DEST_AIRPORT_ID string, CRS_DEP_TIME string, CRS_ELAPSED_TIME string, ARR_DELAY_NEW string")
    [row] = clean_flights(raw).collect()
    assert (row.WEATHER_DELAY, row.HAS_NAS_DELAY) == (0.0, False)


def test_flights_plan_has_no_shuffle_and_reads_kept_columns_only(spark, made):
    raw = tables.read_text_table(spark, f"{made[0].flights_dir}/*.csv")
    plan = clean_flights(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "TAIL_NUM" not in plan


def test_station_map(spark, made):
    stations = read(spark, tables.TablePaths(made[0].out_root).stations)
    assert {tuple(r) for r in stations.collect()} == {
        (10397, 13874, -5), (10397, 53863, -5), (12892, 23174, -8), (14107, 23183, -7)}
    assert stations.count() == 4
    flights = read(spark, tables.TablePaths(made[0].out_root).flights)
    allowed = allowed_stations(stations, flights)
    assert sorted(map(tuple, allowed.collect())) == [(13874, 10397), (23174, 12892), (53863, 10397)]


def test_station_map_keeps_least_known_zone(spark):
    raw = spark.createDataFrame([("1", "5", None), ("1", "5", "-4"), ("1", "5", "-6"), ("2", "5", "x")],
                                "AirportId string, WBAN string, TimeZone string")
    assert sorted(map(tuple, clean_station_map(raw).collect()), key=str) == [(1, 5, -6), (2, 5, None)]


def test_weather(spark, made):
    df = read(spark, tables.TablePaths(made[0].out_root).weather)
    assert df.columns[0] == "WBAN" and not any("Celsius" in c for c in df.columns)
    assert {"StationType", "SkyConditionFlag"} <= set(df.columns) and not {"Date", "Time"} & set(df.columns)
    assert len([c for c in df.columns if c.startswith("wt_score_")]) == 28
    assert df.count() == 6
    types = dict(df.dtypes)
    assert (types["WBAN"], types["AirportId"], types["WindSpeed"], types["PressureTendency"], types["Altimeter"],
            types["Visibility"], types["timestamp"]) == (
        "int", "smallint", "smallint", "tinyint", "float", "string", "timestamp_ntz")
    rows = {(r.WBAN, r.timestamp.strftime("%d %H:%M")): r for r in df.collect()}
    w1, w2, w4 = rows[13874, "01 09:00"], rows[13874, "01 00:53"], rows[13874, "01 09:05"]
    assert (w1.sky_num_layers, w1.sky_min_altitude, w1.sky_has_CB, w1.wt_score_RA, w1.wt_score_BR) == (
        3, 700, True, 1, 2)
    assert w1.HourlyPrecip is None and w2.HourlyPrecip == pytest.approx(0.01)
    assert w2.DryBulbFarenheit is None and w2.WindDirection is None and w2.PressureChange == 21
    assert w4.sky_max_altitude == 35000 and w4.ValueForWindCharacter is None and w4.SeaLevelPressure is None


EXPECTED = {1: (["w4", "w3", "w1", "w2"], ["w5"]), 2: ([], []), 6: ([], []), 7: (["w2"], []),
            8: ([], ["w4", "w3", "w1", "w2"]), 1234: (["w4", "w3", "w1"], [])}


def named(items):
    return [DRY[i.DryBulbFarenheit] for i in items]


def test_joined(made):
    _, joined = made
    assert joined.columns == [
        "FL_DATE", "CRS_DEP_TIMESTAMP", "CRS_ELAPSED_TIME", "CRS_ARR_TIMESTAMP", "ORIGIN_AIRPORT_ID",
        "DEST_AIRPORT_ID", "ARR_DELAY_NEW", "OP_CARRIER", "OP_CARRIER_FL_NUM", "weather_origin", "weather_dest"]
    item = joined.schema["weather_origin"].dataType.elementType
    assert item.names[0] == "w_ts" and len(item.names) == 34 and "WBAN" not in item.names
    rows = {r.OP_CARRIER_FL_NUM: r for r in joined.collect()}
    assert {k: (named(r.weather_origin), named(r.weather_dest)) for k, r in rows.items()} == EXPECTED
    assert rows[1].CRS_ARR_TIMESTAMP == datetime(2012, 1, 1, 10, 40) and rows[7].CRS_ARR_TIMESTAMP is None


@pytest.mark.parametrize("segment_rows", [1_000_000, 2])
def test_single_lag_and_legacy(spark, made, segment_rows):
    paths = tables.TablePaths(made[0].out_root)
    flights, weather = read(spark, paths.flights), read(spark, paths.weather)
    one = enrich(flights, weather, lags=0, segment_rows=segment_rows)
    for r in one.collect():
        for got, want in zip((r.weather_origin_single, r.weather_dest_single), EXPECTED[r.OP_CARRIER_FL_NUM]):
            assert (got and DRY[got.DryBulbFarenheit]) == (want[0] if want else None)
    seven = enrich(flights, weather, lags=7, segment_rows=segment_rows)
    assert {r.OP_CARRIER_FL_NUM: (named(r.weather_origin), named(r.weather_dest)) for r in seven.collect()} == EXPECTED
    legacy = enrich(flights, weather, lags=1, legacy_unmatched=True, segment_rows=segment_rows)
    assert all(len(r.weather_origin) == 1 for r in legacy.collect())


def test_measuring_never_runs_a_join(spark, made, monkeypatch):
    """Counting and sampling read the clean tables, not the result of the origin join."""
    plans, plain = [], asof.find_splits

    def spy(points, *rest):
        plans.append(points._jdf.queryExecution().optimizedPlan().toString())
        return plain(points, *rest)

    monkeypatch.setattr(asof, "find_splits", spy)
    paths = tables.TablePaths(made[0].out_root)
    enrich(read(spark, paths.flights), read(spark, paths.weather))
    assert len(plans) == 2 and not any("Window" in p for p in plans)


def test_zone_shift(spark, made):
    paths = tables.TablePaths(made[0].out_root)
    flights, weather = read(spark, paths.flights), read(spark, paths.weather)
    shifted = enrich(flights, weather, lags=7, zones=read(spark, paths.stations))
    rows = {r.OP_CARRIER_FL_NUM: r for r in shifted.collect()}
    assert rows[1].CRS_ARR_TIMESTAMP == datetime(2012, 1, 1, 7, 40)  # 10:40 at -5 is 7:40 at -8
    assert rows[8].CRS_ARR_TIMESTAMP == datetime(2012, 1, 1, 9, 5)  # origin zone unknown: unchanged
    assert named(rows[1].weather_dest) == []


def test_empty_flights(spark, made):
    paths = tables.TablePaths(made[0].out_root)
    none = enrich(read(spark, paths.flights).limit(0), read(spark, paths.weather))
    assert none.count() == 0 and none.columns[-1] == "weather_dest"


def test_bounds_reach_the_scan(spark, made):
    paths = tables.TablePaths(made[0].out_root)
    low, high = datetime(2012, 1, 1), datetime(2012, 1, 1, 9)
    weather = within(read(spark, paths.weather), "timestamp", (low, high))
    assert weather.count() == 3
    plan = weather._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThanOrEqual(timestamp" in plan
    flights = spark.createDataFrame(
        [(datetime(2012, 3, 1, 5), None), (datetime(2012, 3, 2, 5), datetime(2012, 3, 1, 6))],
        "a timestamp_ntz, b timestamp_ntz")
    assert time_bounds(flights, "a", "b", hours_before=12) == (datetime(2012, 2, 29, 17), datetime(2012, 3, 2, 5))
    assert time_bounds(flights.limit(0), "a", "b") is None


def test_mandatory_columns(spark, made):
    paths = tables.TablePaths(made[0].out_root)
    with pytest.raises(ValueError, match="ARR_DELAY_NEW"):
        enrich(read(spark, paths.flights).drop("ARR_DELAY_NEW"), read(spark, paths.weather))


def test_flat(spark, made):
    config, joined = made
    flat = read(spark, tables.TablePaths(config.out_root).flat(7))
    assert len(flat.columns) == 9 + 2 * 7 * 34 + 2 * 25 * 4
    r = {x.OP_CARRIER_FL_NUM: x for x in flat.collect()}[1]
    assert [r[f"orig_DryBulbFarenheit_lag{k}"] for k in range(7)] == [43.0, 42.0, 41.0, None, None, None, None]
    assert r.orig_wts_lag0 == datetime(2012, 1, 1, 9, 5)
    assert (r.orig_DryBulbFarenheit_min, r.orig_DryBulbFarenheit_max) == (41.0, 43.0)
    assert r.orig_DryBulbFarenheit_avg is None and r.orig_DryBulbFarenheit_delta is None
    three = flat_features(enrich(
        read(spark, tables.TablePaths(config.out_root).flights),
        read(spark, tables.TablePaths(config.out_root).weather), lags=3), 3)
    r = {x.OP_CARRIER_FL_NUM: x for x in three.collect()}[1]
    assert (r.orig_DryBulbFarenheit_avg, r.orig_DryBulbFarenheit_delta) == (42.0, 2.0)
    assert r.orig_sky_max_altitude_max == 35000
    one = flat_features(enrich(
        read(spark, tables.TablePaths(config.out_root).flights),
        read(spark, tables.TablePaths(config.out_root).weather), lags=1), 1)
    r = {x.OP_CARRIER_FL_NUM: x for x in one.collect()}[1]
    assert (r.orig_DryBulbFarenheit_min, r.orig_DryBulbFarenheit_avg, r.orig_DryBulbFarenheit_delta) == (43., 43., 0.)


def test_quality_files(spark, made):
    folder = tables.TablePaths(made[0].out_root).quality
    rows = {r["dataset"]: r.asDict() for r in spark.read.json(f"{folder}/quality_summary.json").collect()}
    assert rows["flight_clean"]["rows"] == 6 and rows["flight_clean"]["non_null_CRS_DEP_TIMESTAMP"] == 5
    assert rows["weather_clean"]["distinct_date"] == 2 and rows["weather_clean"]["distinct_AirportId"] == 2
    assert rows["airport_timezone_clean"]["distinct_WBAN"] == 4
    csv = spark.read.option("header", True).csv(f"{folder}/quality_summary.csv")
    assert len(csv.columns) == 13 and csv.count() == 3
    months = spark.read.option("header", True).csv(f"{folder}/months/weather_clean_months.csv")
    assert [tuple(r) for r in months.collect()] == [("2011-12", "1"), ("2012-01", "5")]
    for name in ("flight_clean", "join_intermediate_lag7", "join_flat_lag7"):
        months = spark.read.option("header", True).csv(f"{folder}/months/{name}_months.csv")
        assert [tuple(r) for r in months.collect()] == [("2012-01", "6")]


def test_catalog(spark, made, tmp_path):
    assert spark.table("job_test.flight_clean").count() == 6
    spark.range(3).write.parquet(f"{tmp_path}/other")
    tables.register_tables(spark, "job_test", {"moving": f"{tmp_path}/other"})
    spark.range(5).write.parquet(f"{tmp_path}/it's new")
    tables.register_tables(spark, "job_test", {"moving": f"{tmp_path}/it's new"})
    assert spark.table("job_test.moving").count() == 5


def test_all_months_and_rerun(spark, made, tmp_path):
    write_raw(tmp_path)
    config = PipelineConfig(
        flights_dir=f"{tmp_path}/Flights", weather_dir=f"{tmp_path}/Weather", station_csv=f"{tmp_path}/stations.csv",
        out_root=f"{tmp_path}/out", mode="prepare", database=None)
    assert run_pipeline(spark, config) is None
    config = replace(config, numeric_visibility=True)
    assert pipeline.prepare(spark, config) == {"flight_clean": 7, "airport_timezone_clean": 4, "weather_clean": 6}
    weather = read(spark, tables.TablePaths(config.out_root).weather)
    assert dict(weather.dtypes)["Visibility"] == "float" and weather.first().Visibility == 10.0
    assert run_pipeline(spark, replace(config, mode="quality")) is None
    single = run_pipeline(spark, replace(config, mode="join", lags=0, tz_adjust=True))
    assert single.count() == 7 and single.columns[-1] == "weather_dest_single"


def test_bad_parameters():
    for bad in ({"mode": "x"}, {"sample_month": "2012"}, {"sample_month": "201213"}, {"lags": -1}, {"hours": -1},
                {"lags": 0, "flat": True}):
        with pytest.raises(ValueError):
            PipelineConfig(**bad)


def test_record_cap_and_count(spark, tmp_path):
    n = tables.write_table(spark.range(100).coalesce(1), f"{tmp_path}/t", max_records=30)
    assert n == 100 and len(list((tmp_path / "t").glob("*.parquet"))) == 4
    again = tables.through_table(spark.range(7), f"{tmp_path}/u")
    assert again.count() == 7 and "FileScan parquet" in again._jdf.queryExecution().executedPlan().toString()


def test_held_lets_go_on_failure(spark):
    df = spark.range(4)
    with pytest.raises(RuntimeError):
        with tables.held(df) as kept:
            assert kept.is_cached
            raise RuntimeError
    assert not df.is_cached


def test_scratch_dir_is_shared_folder(spark):
    assert tables.scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_enrichment_check_makes_only_joined_weather_columns(spark, monkeypatch):
    from asofkit.checks import queries
    from asofkit.plans.features import JOIN_FEATURES

    written, plain = {}, queries.io.through_table
    monkeypatch.setattr(queries.io, "through_table", lambda df, path: written.setdefault(path.rsplit("/", 1)[1], plain(df, path)))
    queries.flat_all_features(spark, "/root/testdata/sf0.001")
    assert set(written["weather_clean.parquet"].columns) == {"WBAN", "AirportId", "timestamp", *JOIN_FEATURES}
