"""Interval join (J3, J4) and time pruning of one table by another."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asofkit.functions.clock import micros

_MICROS_PER_HOUR = 3_600_000_000


def interval_join(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str] | str,
    left_ts: str,
    right_ts: str,
    right_by: Sequence[str] | str | None = None,
    hours: int = 12,
) -> DataFrame:
    """Left join of each left row to all right rows of its key within ``[left_ts - hours, left_ts]``.

    Time is cut into buckets of ``hours``. A right row stands in its own bucket and in the next, so a left row finds all its
    partners in its own bucket alone: one outer equi-join on (key, bucket), each side read and shuffled once, tells the matches
    and the left rows without any. Adaptive execution splits a hot bucket on the left side. Left rows without key or
    time match nothing; they are dealt over the tasks by their hash and input partition, never gathered.
    """
    by = [by] if isinstance(by, str) else list(by)
    right_by = by if right_by is None else [right_by] if isinstance(right_by, str) else list(right_by)
    if hours <= 0:
        raise ValueError(f"hours must be positive: {hours}")
    width = hours * _MICROS_PER_HOUR
    right_columns = [c for c in right.columns if c not in right_by or c not in by]
    clash = set(left.columns) & set(right_columns)
    if clash:
        raise ValueError(f"rename columns present on both sides: {sorted(clash)}")

    def bucket(df: DataFrame, ts: str) -> Column:
        zoneless = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
        t = micros(F.col(ts), zoneless)
        return t - F.pmod(t, F.lit(width))

    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*by, left_ts)])
    deal = F.xxhash64(*[f.name for f in left.schema if isinstance(f.dataType, T.AtomicType)], F.spark_partition_id())
    probes = left.withColumns({
        "_own": F.when(complete, bucket(left, left_ts)).otherwise(deal),
        "_from": F.timestamp_add("HOUR", F.lit(-hours), F.col(left_ts)),
    })
    placed = right.na.drop(subset=[*right_by, right_ts]).select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(right_by)], *right_columns,
        F.explode(F.array(bucket(right, right_ts), bucket(right, right_ts) + width)).alias("_b"),
    )
    keys = [probes[c] == placed[f"_k{i}"] for i, c in enumerate(by)]
    return probes.join(
        placed,
        [*keys, probes["_own"] == placed["_b"], placed[right_ts].between(probes["_from"], probes[left_ts])],
        "left",
    ).select(*left.columns, *right_columns)


def time_bounds(df: DataFrame, first: str, *ends: str, hours_before: int = 0) -> tuple[datetime, datetime] | None:
    """A1/C11: (min(first) - hours, max over ``first`` and ``ends``) in one pass; None when there is no time."""
    latest = F.greatest(F.max(first), *[F.max(c) for c in ends]) if ends else F.max(first)
    earliest = F.timestamp_add("HOUR", F.lit(-hours_before), F.min(first))
    if ends:
        earliest = F.timestamp_add("HOUR", F.lit(-hours_before), F.least(F.min(first), *[F.min(c) for c in ends]))
    low, high = df.agg(earliest, latest).first()
    return None if low is None else (low, high)


def within(df: DataFrame, ts: str, bounds: tuple[datetime, datetime] | None) -> DataFrame:
    """keep rows inside the bounds, given as literals so that the scan can skip files by its statistics."""
    if bounds is None:
        return df.limit(0)
    zoneless = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    # as text, a zoneless bound passes no zone on its way back into a literal
    low, high = (F.lit(str(b)).cast("timestamp_ntz") if zoneless else F.lit(b) for b in bounds)
    return df.where(F.col(ts).between(low, high))
