"""Column expressions: one case per row of the tables in FIXTURES.md, section 3, and more edges."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from asofkit.functions import casts, clock, codes
from asofkit.plans.features import add_sky_features, add_weather_scores


def values(spark, texts, expr, kind="string"):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("x"))).collect()]


def test_missing_and_trace(spark):
    texts = ["", " ", "M", " M ", "m", "MM", " 12", None]
    assert values(spark, texts, casts.null_if_missing) == [None, None, None, None, "m", "MM", " 12", None]
    assert values(spark, ["T", " T ", "0.1", None], casts.null_if_trace) == [None, None, "0.1", None]


@pytest.mark.parametrize("kind,cases", [
    ("smallint", {"1234.0": 1234, " 12 ": 12, "+010": 10, "-5.9": -5, "VR": None, "70000": None, "70000.0": None,
                  "NaN": None, None: None, "": None, "12.x": None, "32767": 32767, "-32768.0": -32768, "1e3": None}),
    ("tinyint", {"127": 127, "128": None, "-5": -5}),
    ("int", {"13874": 13874, "3000000000": None}),
])
def test_whole_numbers(spark, kind, cases):
    assert values(spark, list(cases), lambda c: casts.to_whole(c, kind)) == list(cases.values())


def test_real_numbers_default_and_flags(spark):
    assert values(spark, ["1.5", " -2 ", "x", "", None], casts.to_real) == [1.5, -2.0, None, None, None]
    assert values(spark, ["15", "x", None], lambda c: casts.value_or(casts.to_real(c), 0.0)) == [15.0, 0.0, 0.0]
    assert values(spark, ["1", "1.00", "0.00", "abc", None], casts.is_set) == [True, True, False, None, None]


def test_dates(spark):
    assert values(spark, ["2012-01-05", "2012-02-30", "x", None], clock.iso_date) == [date(2012, 1, 5)] + [None] * 3
    assert values(spark, ["20120105", "20120230", "", None], clock.compact_date) == [date(2012, 1, 5)] + [None] * 3


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_wall_clock_under_any_zone(spark, zone):
    cases = {"5": (0, 5), "905": (9, 5), "0230": (2, 30), "2359": (23, 59), "2400": None, "0960": None,
             "ab": None, "12:3": None, " 905": None, "09051": (9, 5), None: None}
    spark.conf.set("spark.sql.session.timeZone", zone)
    got = values(spark, list(cases), lambda c: clock.wall_clock(F.lit(date(2012, 3, 11)), c))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [v and datetime(2012, 3, 11, *v) for v in cases.values()]


def test_add_minutes_cuts_to_seconds(spark):
    base = F.lit("2012-03-11 01:55:00").cast("timestamp_ntz")
    got = values(spark, [95.0, 1.63, -5.0, None, float("nan"), 1e30], lambda c: clock.add_minutes(base, c), "double")
    assert got == [datetime(2012, 3, 11, 3, 30), datetime(2012, 3, 11, 1, 56, 37), datetime(2012, 3, 11, 1, 50),
                   None, None, None]


SKY = {  # text: layers, min, max, mean, CB, TCU, OVC
    "CLR": (1, None, None, None, False, False, False),
    "FEW007 SCT014 OVC020CB": (3, 700, 2000, 1366.667, True, False, True),
    "BKN350": (1, 35000, 35000, 35000.0, False, False, False),
    "VV001": (1, 100, 100, 100.0, False, False, False),
    "": (0, None, None, None, False, False, False),
    "M": (0, None, None, None, False, False, False),
    None: (0, None, None, None, False, False, None),
    " BKN020  OVC060TCU ": (2, 2000, 6000, 4000.0, False, True, True),
    "10/100 SCT030": (2, 3000, 3000, 3000.0, False, False, False),
    "\tFEW010\n": (1, 1000, 1000, 1000.0, False, False, False),
}


def test_sky_features(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(SKY)], "i int, SkyCondition string")
    rows = add_sky_features(df).orderBy("i").collect()
    for r, want in zip(rows, SKY.values()):
        got = (r.sky_num_layers, r.sky_min_altitude, r.sky_max_altitude,
               r.sky_mean_altitude and round(r.sky_mean_altitude, 3), r.sky_has_CB, r.sky_has_TCU, r.sky_has_OVC)
        assert got == want, r.SkyCondition
    assert [c for c in rows[0].asDict()][-5:] == ["sky_has_OVC", "sky_has_BKN", "sky_has_SCT", "sky_has_FEW",
                                                  "sky_has_VV"]
    heights = values(spark, ["FEW007 SCT014", "123456", "1/234", None], codes.sky_altitudes)
    assert heights == [[700, 1400], [12300, 45600], [], []]


WEATHER = {
    "-RA BR": {"RA": 1, "BR": 2},
    "-FZRA+SN": {"FZ": 1, "RA": 2, "SN": 4},
    "TSRA": {"TS": 2, "RA": 2},
    "RA -RA": {"RA": 1},
    "-RA RA": {"RA": 2},
    "+FC VCSH": {"FC": 4, "VC": 2, "SH": 2},
    "": {}, "M": {}, None: {},
}


def test_weather_scores(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(WEATHER)], "i int, WeatherType string")
    for r, want in zip(add_weather_scores(df).orderBy("i").collect(), WEATHER.values()):
        got = {c: r[f"wt_score_{c}"] for c in codes.WEATHER_CODES}
        assert got == {c: want.get(c, 0) for c in codes.WEATHER_CODES}
    assert len(codes.WEATHER_CODES) == len(set(codes.WEATHER_CODES)) == 28
    assert values(spark, ["+RA", "TSRA"], lambda c: codes.weather_score(c, "SR")) == [0, 0]
