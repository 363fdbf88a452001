"""Cleaning of all-string event and sensor tables, and their join in time, on Spark DataFrames."""

from asofkit.operators.asof import asof_lags
from asofkit.operators.intervals import interval_join
from asofkit.plans.cleaning import clean_flights, clean_station_map, clean_weather
from asofkit.plans.enrich import enrich, flat_features
from asofkit.plans.pipeline import PipelineConfig, run_pipeline
from asofkit.plans.quality import quality_report

__all__ = [
    "PipelineConfig", "asof_lags", "clean_flights", "clean_station_map", "clean_weather", "enrich",
    "flat_features", "interval_join", "quality_report", "run_pipeline",
]
