"""Flights with the weather that led up to departure and arrival; Z6: the same, flat."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asofkit.functions import clock
from asofkit.operators.asof import SEGMENT_ROWS, asof_lags
from asofkit.operators.intervals import within
from asofkit.operators.lags import flatten_lags
from asofkit.operators.shaping import require, sanitise_names, select_features
from asofkit.plans.features import JOIN_FEATURES

# Flight columns of the joined table.
MANDATORY = (
    "FL_DATE", "CRS_DEP_TIMESTAMP", "CRS_ELAPSED_TIME", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "ARR_DELAY_NEW",
)
OPTIONAL = ("OP_UNIQUE_CARRIER", "OP_CARRIER", "OP_CARRIER_FL_NUM", "OP_CARRIER_AIRLINE_ID")
OUTPUT_ORDER = (
    "FL_DATE", "CRS_DEP_TIMESTAMP", "CRS_ELAPSED_TIME", "CRS_ARR_TIMESTAMP", "ORIGIN_AIRPORT_ID",
    "DEST_AIRPORT_ID", "ARR_DELAY_NEW",
)


def with_arrival(flights: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """The needed flight columns plus the planned arrival.

    Arrival is told by the clock of the origin. Given ``zones`` (AirportId, TimeZone) it is moved to the clock of
    the destination instead, where both zones are known.
    """
    df = require(flights, MANDATORY, OPTIONAL).withColumn(
        "CRS_ARR_TIMESTAMP", clock.add_minutes(F.col("CRS_DEP_TIMESTAMP"), F.col("CRS_ELAPSED_TIME"))
    )
    if zones is None:
        return df
    columns = df.columns
    per_airport = zones.groupBy("AirportId").agg(F.min("TimeZone").cast("int").alias("tz"))
    for side, key in (("orig", "ORIGIN_AIRPORT_ID"), ("dest", "DEST_AIRPORT_ID")):
        renamed = per_airport.select(F.col("AirportId").alias(key), F.col("tz").alias(f"_tz_{side}"))
        df = df.join(renamed, key, "left")
    shift = F.coalesce(F.col("_tz_dest") - F.col("_tz_orig"), F.lit(0))
    return df.withColumn("CRS_ARR_TIMESTAMP", clock.add_hours(F.col("CRS_ARR_TIMESTAMP"), shift)).select(*columns)


@dataclass(frozen=True)
class Seen:
    """Rows of both tables, and the earliest and latest time of a flight (None if it has none)."""

    flights: int
    weather: int
    first: datetime | None
    last: datetime | None


def flight_measures() -> dict[str, Column]:
    """A1: the bounds of clean flights, for ``sources.tables.write_measured``. Arrivals by the clock of the origin."""
    dep = F.col("CRS_DEP_TIMESTAMP")
    arr = clock.add_minutes(dep, F.col("CRS_ELAPSED_TIME"))
    return {"first": F.least(F.min(dep), F.min(arr)), "last": F.greatest(F.max(dep), F.max(arr))}


def measured(timed: DataFrame, weather: DataFrame) -> Seen:
    """``Seen`` of flights with their arrival, by one pass over their times, and of weather, whose count Parquet keeps."""
    both = [F.col("CRS_DEP_TIMESTAMP"), F.col("CRS_ARR_TIMESTAMP")]
    rows, first, last = timed.agg(
        F.count(F.lit(1)), F.least(*map(F.min, both)), F.greatest(*map(F.max, both))).first()
    return Seen(rows, weather.count(), first, last)


def enrich(
    flights: DataFrame,
    weather: DataFrame,
    *,
    hours: int = 12,
    lags: int = 7,
    features: Sequence[str] = JOIN_FEATURES,
    tie_break: Sequence[str] = ("WBAN",),
    zones: DataFrame | None = None,
    legacy_unmatched: bool = False,
    segment_rows: int = SEGMENT_ROWS,
    max_pieces: int | None = None,
    seen: Seen | None = None,
) -> DataFrame:
    """One row per flight with ``weather_origin`` and ``weather_dest`` (array<struct>, newest first), or with
    ``lags`` = 0 ``weather_origin_single`` and ``weather_dest_single`` (struct).

    The rows that come out of the origin join go straight into the destination join: no surrogate id, no join
    back. ``zones`` turns on the time-zone shift of arrivals. ``seen``: what is known of both tables since they were written;
    without it one pass over the flights' times and a count of the weather come first.
    """
    if lags < 0:
        raise ValueError(f"lags must not be negative: {lags}")
    timed = with_arrival(flights, zones)
    seen = measured(timed, weather) if seen is None else seen
    bounds = None if seen.first is None else (seen.first - timedelta(hours=hours), seen.last)
    observations, names = select_features(
        within(weather, "timestamp", bounds), "AirportId", "timestamp", features, extra=tie_break
    )
    ties = [c for c in tie_break if c in observations.columns]
    df, kind = timed, "" if lags else "_single"
    # Both joins see as many rows; where they are cut is measured without the zones' joins, as cuts never change results.
    total, plain = seen.flights + seen.weather, with_arrival(flights)
    for side, key, ts in (
        ("origin", "ORIGIN_AIRPORT_ID", "CRS_DEP_TIMESTAMP"),
        ("dest", "DEST_AIRPORT_ID", "CRS_ARR_TIMESTAMP"),
    ):
        df = asof_lags(
            df, observations, by=key, right_by="apt_id", left_ts=ts, right_ts="w_ts", tolerance_hours=hours,
            lags=lags, payload=names, tie_break=ties, out=f"weather_{side}{kind}",
            legacy_unmatched=legacy_unmatched, segment_rows=segment_rows, max_pieces=max_pieces, measure=plain,
            total=total,
        )
    present = [c for c in OPTIONAL if c in df.columns]
    return df.select(*OUTPUT_ORDER, *present, f"weather_origin{kind}", f"weather_dest{kind}")


def flat_features(joined: DataFrame, lags: int) -> DataFrame:
    """The joined table with one column per side, feature and lag, and across-lag statistics."""
    return sanitise_names(flatten_lags(joined, {"weather_origin": "orig", "weather_dest": "dest"}, lags))
