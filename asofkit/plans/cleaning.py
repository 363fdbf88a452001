"""Cleaning stages Z1-Z3: all-string raw tables to typed, restricted, featurised ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofkit.functions import casts, clock
from asofkit.operators.reducing import attach_keys, dedup_first, ids_in_use, restrict_to
from asofkit.operators.shaping import add_missing, drop_matching, keep_present, typed
from asofkit.plans.features import add_sky_features, add_weather_scores

# The raw flight columns that are read.
FLIGHT_COLUMNS = (
    "FL_DATE", "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "CRS_DEP_TIME",
    "CRS_ELAPSED_TIME", "ARR_DELAY_NEW", "WEATHER_DELAY", "NAS_DELAY", "CANCELLED", "DIVERTED",
)

# The type each weather measure gets.
WEATHER_TYPES = {
    "DryBulbFarenheit": "float",
    "WetBulbFarenheit": "float",
    "DewPointFarenheit": "float",
    "RelativeHumidity": "smallint",
    "WindSpeed": "smallint",
    "WindDirection": "smallint",
    "ValueForWindCharacter": "tinyint",
    "PressureTendency": "tinyint",
    "PressureChange": "smallint",
    "Altimeter": "float",
    "SeaLevelPressure": "float",
    "StationPressure": "float",
    "HourlyPrecip": "float",
}


def clean_flights(raw: DataFrame, airport_ids: str = "smallint") -> DataFrame:
    """Flights that were flown as planned, typed. One scan, no shuffle.

    ``airport_ids``: the whole type of the airports' ids. Those of the real files fit a smallint; ids that don't fit the type
    become NULL, so tables with larger ones need a wider type.
    """
    df = keep_present(raw, FLIGHT_COLUMNS)
    for flag in ("CANCELLED", "DIVERTED"):
        if flag in df.columns:
            df = df.where(~casts.is_set(F.col(flag)))  # an unknown flag drops the row too
    df = df.drop("CANCELLED", "DIVERTED")
    df = add_missing(df, {"WEATHER_DELAY": "string", "NAS_DELAY": "string"})
    df = casts.with_whole(df, {
        "OP_CARRIER_FL_NUM": "smallint", "ORIGIN_AIRPORT_ID": airport_ids, "DEST_AIRPORT_ID": airport_ids})
    # every expression reads the raw values: the HAS_ flags see them before defaults are filled in
    return df.withColumns({
        "FL_DATE": clock.iso_date(F.col("FL_DATE")),
        "CRS_ELAPSED_TIME": casts.to_real(F.col("CRS_ELAPSED_TIME")),
        "ARR_DELAY_NEW": casts.to_real(F.col("ARR_DELAY_NEW")),
        "WEATHER_DELAY": casts.value_or(casts.to_real(F.col("WEATHER_DELAY")), 0.0).cast("float"),
        "NAS_DELAY": casts.value_or(casts.to_real(F.col("NAS_DELAY")), 0.0).cast("float"),
        "HAS_WEATHER_DELAY": F.col("WEATHER_DELAY").isNotNull(),
        "HAS_NAS_DELAY": F.col("NAS_DELAY").isNotNull(),
        "CRS_DEP_TIMESTAMP": clock.wall_clock(clock.iso_date(F.col("FL_DATE")), F.col("CRS_DEP_TIME")),
    })


def clean_station_map(raw: DataFrame, airport_ids: str = "smallint", station_ids: str = "int") -> DataFrame:
    """Typed (AirportId, WBAN, TimeZone), unique by the first two; of several zones the least known one.

    ``airport_ids`` and ``station_ids``: the whole types of the ids. A row with an id that doesn't fit its type is dropped, so tables
    with larger ones than the real files need wider types.
    """
    df = typed(raw, {
        "AirportId": casts.to_whole(F.col("AirportId"), airport_ids),
        "WBAN": casts.to_whole(F.col("WBAN"), station_ids),
        "TimeZone": casts.to_whole(F.col("TimeZone"), "tinyint"),
    }).na.drop(subset=["AirportId", "WBAN"])
    return dedup_first(df, ["AirportId", "WBAN"], order=[F.col("TimeZone").isNull()])


def allowed_stations(
    station_map: DataFrame, flights: DataFrame, ids: Sequence[str] = ("ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID")
) -> DataFrame:
    """Distinct (WBAN, AirportId) of the airports that flights use."""
    used = ids_in_use(flights, ids, "AirportId")
    return restrict_to(station_map, used, "AirportId").select("WBAN", "AirportId").distinct()


def allowed_station_days(station_map: DataFrame, flights: DataFrame, hours: int, slack_days: int = 0) -> DataFrame:
    """J1 + F5: distinct (WBAN, AirportId, day) that a flight can look back on: at its origin the days from ``hours`` before departure,
    at its destination those before arrival. ``slack_days`` more on both ends where arrivals will be moved to another zone."""
    dep = F.col("CRS_DEP_TIMESTAMP")
    stops = F.array(
        F.struct(F.col("ORIGIN_AIRPORT_ID").alias("AirportId"), dep.alias("t")),
        F.struct(F.col("DEST_AIRPORT_ID").alias("AirportId"), clock.add_minutes(dep, F.col("CRS_ELAPSED_TIME")).alias("t")))
    first = F.date_sub(F.to_date(clock.add_hours(F.col("s.t"), -hours)), slack_days)
    used = (flights.select(F.explode(stops).alias("s")).where(F.col("s.AirportId").isNotNull() & F.col("s.t").isNotNull())
            .select("s.AirportId", F.explode(F.sequence(first, F.date_add(F.to_date(F.col("s.t")), slack_days))).alias("_day")).distinct())
    return attach_keys(station_map.select("WBAN", "AirportId").distinct(), used, "AirportId").select("WBAN", "AirportId", "_day")


def type_weather(df: DataFrame) -> DataFrame:
    """A timestamp for Date and Time, measures per ``WEATHER_TYPES``.

    The number patterns refuse the marks of missing values and trace amounts (F7, F8), so these become NULL.
    """
    df = casts.with_whole(df, {n: t for n, t in WEATHER_TYPES.items() if t != "float"})
    columns = {n: casts.to_real(F.col(n)) for n, t in WEATHER_TYPES.items() if t == "float"}
    columns["timestamp"] = clock.wall_clock(clock.compact_date(F.col("Date")), F.col("Time"))
    return df.withColumns(columns).drop("Date", "Time")


def clean_weather(
    raw: DataFrame,
    station_map: DataFrame,
    flights: DataFrame,
    ids: Sequence[str] = ("ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID"),
    numeric_visibility: bool = False,
    look_back_hours: int | None = None,
    slack_days: int = 0,
    station_ids: str = "int",
) -> DataFrame:
    """Z3: weather at the airports in use, typed and with features; no Celsius columns.

    Only the station is parsed before the restriction, so rows of other stations cost little more than their
    scan. Typing stands between the two feature steps, whose lambdas end a generated method: in one method with
    either of them it would be too large for the JVM to compile. ``Visibility`` stays text, and so no numeric
    feature, unless asked for. With ``look_back_hours`` only the days that a flight of the station's airport can look back on are
    kept, told by the date alone before anything else is parsed: what is joined to flights does not change. ``station_ids`` is
    the whole type of the stations' ids, as in the station map.
    """
    kept = casts.with_whole(drop_matching(raw, "Celsius"), {"WBAN": station_ids})
    if look_back_hours is None:
        allowed = allowed_stations(station_map, flights, ids).where(F.col("AirportId").isNotNull())
        here = attach_keys(kept, allowed, "WBAN")
    else:
        allowed = allowed_station_days(station_map, flights, look_back_hours, slack_days)
        here = attach_keys(kept.withColumn("_day", clock.compact_date(F.col("Date"))), allowed, ["WBAN", "_day"]).drop("_day")
    df = add_weather_scores(type_weather(add_sky_features(here)))
    if numeric_visibility and "Visibility" in df.columns:
        df = df.withColumn("Visibility", casts.to_real(F.col("Visibility")))
    head = [c for c in here.columns if c.lower() not in ("date", "time", "airportid")]
    made = [c for c in df.columns if c.startswith(("sky_", "wt_score_"))]
    return df.select(*head, "timestamp", "AirportId", *made)
