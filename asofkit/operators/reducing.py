"""Distinct, dedup, restriction, top-N and counts: operators that shrink a table before anything moves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asofkit.functions.clock import month


def ids_in_use(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """U1 + A6: the distinct values of several columns as one, read in one scan."""
    return df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias(out)).distinct()


def restrict_to(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key is in ``keys``, each once, whatever the multiplicity there."""
    return df.join(keys, on, "left_semi")


def attach_keys(df: DataFrame, mapping: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Inner join that filters and attaches at once; a key mapped k times yields k rows.

    No broadcast hint: the planner broadcasts a mapping under its size threshold, and joins a larger one by
    shuffling, where adaptive execution splits hot keys.
    """
    return df.join(mapping, on)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key, the least by ``order`` and then by all other columns. Combined map-side."""
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)], F.struct(*rest).alias("row"))
    least = df.groupBy(*keys).agg(F.min(ranked).alias("_m"))
    return least.select([F.col(c) if c in keys else F.col("_m.row")[c].alias(c) for c in df.columns])


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rk") -> DataFrame:
    """W1 + F6 + T1: the first N rows per group, ranked; Spark cuts each group to N before the shuffle as well."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def collect_newest(df: DataFrame, by: Sequence[str], ts: str, fields: Sequence[str], n: int, out: str) -> DataFrame:
    """A2: per group the N newest (ts, fields) structs, newest first."""
    item = F.struct(ts, *[f for f in fields if f != ts])
    few = top_n(df.withColumn("_i", item), by, [F.col("_i").desc()], n)
    return few.groupBy(*by).agg(F.sort_array(F.collect_list("_i"), asc=False).alias(out))


def month_counts(df: DataFrame, day: str) -> DataFrame:
    """A9 + T2: rows per ``yyyy-MM``, in month order."""
    return df.groupBy(month(F.col(day)).alias("month")).agg(F.count(F.lit(1)).alias("n")).orderBy("month")
