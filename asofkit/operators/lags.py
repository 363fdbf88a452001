"""Wide, model-ready columns from nested lags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lag_fields(df: DataFrame, array: str, ts_name: str = "w_ts") -> tuple[list[str], list[str]]:
    """(all features, numeric features) of an array<struct> column, told by its schema."""
    fields = [f for f in df.schema[array].dataType.elementType.fields if f.name != ts_name]
    return [f.name for f in fields], [f.name for f in fields if isinstance(f.dataType, T.NumericType)]


def lag_columns(array: str, prefix: str, features: Sequence[str], lags: int, ts_name: str = "w_ts") -> list[Column]:
    """``{prefix}_{feature}_lag{k}`` and ``{prefix}_wts_lag{k}``; NULL past the end of the array."""
    columns = []
    for k in range(lags):
        item = f"get(`{array}`, {k})"
        columns += [F.expr(f"{item}.`{f}` AS `{prefix}_{f}_lag{k}`") for f in features]
        columns.append(F.expr(f"{item}.`{ts_name}` AS `{prefix}_wts_lag{k}`"))
    return columns


def lag_stats(prefix: str, feature: str, lags: int) -> list[Column]:
    """A10 over flattened lag columns: min and max skip NULLs; avg is NULL unless all lags are there; delta is
    newest minus oldest. avg and delta are computed as doubles, so small integer types cannot overflow."""
    names = [f"`{prefix}_{feature}_lag{k}`" for k in range(lags)]
    values = [f"double({n})" for n in names]
    low, high = (f"least({', '.join(names)})", f"greatest({', '.join(names)})") if lags > 1 else names * 2
    stem = f"{prefix}_{feature}"
    return [
        F.expr(f"{low} AS `{stem}_min`"),
        F.expr(f"{high} AS `{stem}_max`"),
        F.expr(f"({' + '.join(values)}) / {lags} AS `{stem}_avg`"),
        F.expr(f"{values[0]} - {values[-1]} AS `{stem}_delta`"),
    ]


def flatten_lags(df: DataFrame, arrays: dict[str, str], lags: int, ts_name: str = "w_ts") -> DataFrame:
    """Lag columns of each array (column -> prefix), then the across-lag statistics of numeric features.

    Row-wise: no shuffle, each array element is read by position.
    """
    if lags < 1:
        raise ValueError(f"flattening needs at least one lag: {lags}")
    plain = [c for c in df.columns if c not in arrays]
    wide, stats = [], []
    for array, prefix in arrays.items():
        features, numeric = lag_fields(df, array, ts_name)
        wide += lag_columns(array, prefix, features, lags, ts_name)
        for f in numeric:
            stats += lag_stats(prefix, f, lags)
    return df.select(*plain, *wide).select("*", *stats)
