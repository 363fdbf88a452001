"""The whole job by mode: prepare, quality, join, all."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from asofkit.operators.asof import SEGMENT_ROWS
from asofkit.operators.reducing import month_counts
from asofkit.plans.cleaning import clean_flights, clean_station_map, clean_weather
from asofkit.plans.enrich import Seen, enrich, flat_features, flight_measures
from asofkit.plans.quality import default_metrics, measured_report, measures, quality_report
from asofkit.sources.tables import (
    MAX_RECORDS_PER_FILE,
    TablePaths,
    held,
    input_globs,
    read_table,
    read_text_table,
    register_tables,
    through_table,
    write_measured,
    write_month_counts,
    write_report,
    write_table,
)

MODES = ("prepare", "quality", "join", "all")


@dataclass(frozen=True)
class PipelineConfig:
    """Inputs, output root and parameters. ``database`` None leaves the catalog alone; ``weather_in_reach`` keeps of the weather only
    days that some flight can look back on within ``hours``; ``airport_ids`` is the whole type of the flights' airport ids."""

    flights_dir: str = "data/Flights"
    weather_dir: str = "data/Weather"
    station_csv: str = "data/wban_airport_timezone.csv"
    out_root: str = "out"
    hours: int = 12
    lags: int = 7
    mode: str = "all"
    sample_month: str | None = None
    fmt: str = "parquet"
    database: str | None = "flight_weather"
    exact_quality: bool = False
    tz_adjust: bool = False
    numeric_visibility: bool = False
    weather_in_reach: bool = False
    legacy_unmatched: bool = False
    flat: bool = False
    month_report: bool = False
    segment_rows: int = SEGMENT_ROWS
    max_pieces: int | None = None
    airport_ids: str = "smallint"

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {', '.join(MODES)}: {self.mode!r}")
        if self.hours < 0 or self.lags < 0:
            raise ValueError("hours and lags must not be negative")
        if self.flat and self.lags == 0:
            raise ValueError("a flat table needs at least one lag")
        input_globs(self.flights_dir, self.weather_dir, self.sample_month)


def prepare(spark: SparkSession, config: PipelineConfig) -> dict[str, int]:
    """Write the three clean tables, register them, report on them. Returns rows written per table."""
    return {name: seen["rows"] for name, seen in prepare_measured(spark, config).items()}


def prepare_measured(spark: SparkSession, config: PipelineConfig) -> dict[str, dict]:
    """``prepare``; returns what was measured of each table while writing.

    Each stage reads back what the one before wrote, so no text is parsed twice; the report and the join's bounds and
    row counts come from the writes, so no table is scanned for them.
    """
    paths, metrics = TablePaths(config.out_root), default_metrics()
    flights_glob, weather_glob = input_globs(config.flights_dir, config.weather_dir, config.sample_month)

    def write(df: DataFrame, name: str, path: str, more: dict | None = None) -> dict:
        return write_measured(df, path, measures(metrics[name]) | (more or {}), config.fmt)

    seen = {
        "flight_clean": write(
            clean_flights(read_text_table(spark, flights_glob), config.airport_ids), "flight_clean", paths.flights, flight_measures()),
        "airport_timezone_clean": write(
            clean_station_map(read_text_table(spark, config.station_csv)), "airport_timezone_clean", paths.stations),
    }
    seen["weather_clean"] = write(
        clean_weather(
            read_text_table(spark, weather_glob),
            read_table(spark, paths.stations, config.fmt),
            read_table(spark, paths.flights, config.fmt),
            numeric_visibility=config.numeric_visibility,
            look_back_hours=config.hours if config.weather_in_reach else None,
            slack_days=1 if config.tz_adjust else 0,
        ),
        "weather_clean", paths.weather,
    )
    if config.database:
        register_tables(spark, config.database, {
            "flight_clean": paths.flights,
            "weather_clean": paths.weather,
            "airport_timezone_clean": paths.stations,
        }, config.fmt)
    report(spark, config, None if config.exact_quality else seen)
    return seen


def report(spark: SparkSession, config: PipelineConfig, seen: dict[str, dict] | None = None) -> None:
    """Write the quality report as JSON and CSV: from what was ``seen`` while writing, or counted once; written twice."""
    paths = TablePaths(config.out_root)
    places = {"flight_clean": paths.flights, "weather_clean": paths.weather, "airport_timezone_clean": paths.stations}
    if seen is None:
        summary = quality_report({n: read_table(spark, p, config.fmt) for n, p in places.items()}, exact=config.exact_quality)
    else:
        summary = measured_report(spark, {n: seen[n] for n in places})
    with held(summary):
        write_report(summary, f"{paths.quality}/quality_summary.json", "json")
        write_report(summary, f"{paths.quality}/quality_summary.csv", "csv")


def report_months(spark: SparkSession, config: PipelineConfig) -> None:
    """Write month counts of the clean, joined and (when asked for) flat tables."""
    paths = TablePaths(config.out_root)
    days = {
        "flight_clean": (paths.flights, "FL_DATE"),
        "weather_clean": (paths.weather, "timestamp"),
        f"join_intermediate_lag{config.lags}": (paths.joined(config.lags), "FL_DATE"),
    }
    if config.flat:
        days[f"join_flat_lag{config.lags}"] = (paths.flat(config.lags), "FL_DATE")
    for name, (path, day) in days.items():
        counts = month_counts(read_table(spark, path, config.fmt), day)
        write_month_counts(counts, f"{paths.quality}/months/{name}_months.csv")


def join(spark: SparkSession, config: PipelineConfig, seen: dict[str, dict] | None = None) -> DataFrame:
    """Write the joined table, and the flat one when asked for; returns the joined table as written.

    ``seen``: what ``prepare`` measured. Arrivals moved to another zone are measured anew."""
    known = None
    if seen is not None and not config.tz_adjust:
        flights = seen["flight_clean"]
        known = Seen(flights["rows"], seen["weather_clean"]["rows"], flights["first"], flights["last"])
    paths = TablePaths(config.out_root)
    zones = read_table(spark, paths.stations, config.fmt) if config.tz_adjust else None
    joined = through_table(
        enrich(
            read_table(spark, paths.flights, config.fmt),
            read_table(spark, paths.weather, config.fmt),
            hours=config.hours, lags=config.lags, zones=zones,
            legacy_unmatched=config.legacy_unmatched, segment_rows=config.segment_rows, max_pieces=config.max_pieces,
            seen=known,
        ),
        paths.joined(config.lags), config.fmt, MAX_RECORDS_PER_FILE,
    )
    if config.flat:
        write_table(flat_features(joined, config.lags), paths.flat(config.lags), config.fmt, MAX_RECORDS_PER_FILE)
    return joined


def run_pipeline(spark: SparkSession, config: PipelineConfig) -> DataFrame | None:
    """Run the job; returns the joined table, or None for modes that do not join."""
    seen = prepare_measured(spark, config) if config.mode in ("prepare", "all") else None
    if config.mode == "quality":
        report(spark, config)
        return None
    if config.mode == "prepare":
        return None
    joined = join(spark, config, seen)
    if config.month_report:
        report_months(spark, config)
    return joined
