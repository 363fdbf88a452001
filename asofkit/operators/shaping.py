"""Projections that shape a table: keep-lists, renames, target schemas."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that table formats refuse in column names.
_BAD_NAME = re.compile(r"[ ,;{}()\n\t=]+")


def keep_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select([n for n in names if n in df.columns])


def drop_matching(df: DataFrame, part: str) -> DataFrame:
    """Without the columns whose name contains ``part``."""
    return df.select([n for n in df.columns if part not in n])


def require(df: DataFrame, mandatory: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """P5: mandatory columns, then the optional ones that exist; a clear error names what is missing."""
    missing = [n for n in mandatory if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return keep_present(df, [*mandatory, *optional])


def typed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Exactly the given expressions, under the given names."""
    return df.select([c.alias(n) for n, c in columns.items()])


def with_prefix(df: DataFrame, prefix: str, names: Iterable[str]) -> DataFrame:
    """Put a side's prefix before the given columns."""
    return df.withColumnsRenamed({n: f"{prefix}{n}" for n in names})


def with_family(df: DataFrame, prefix: str, members: Iterable[str], make) -> DataFrame:
    """One column ``prefix + member`` per member, all in one projection."""
    return df.withColumns({f"{prefix}{m}": make(m) for m in members})


def add_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Q14: typed NULL columns for those that are absent."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The target schema: cast, reorder, add missing columns as typed NULL."""
    return df.select([
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def labelled(df: DataFrame, name: str, value: str) -> DataFrame:
    """A constant label column."""
    return df.withColumn(name, F.lit(value))


def packed(df: DataFrame, fields: Sequence[str], out: str) -> DataFrame:
    """The fields as one struct column in place of themselves."""
    return df.select(*[c for c in df.columns if c not in fields], F.struct(*fields).alias(out))


def select_features(
    df: DataFrame, key: str, ts: str, features: Sequence[str], extra: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Key and time as ``apt_id`` and ``w_ts``, then those whitelisted features that exist.

    Returns the table and the feature names. ``extra`` columns (tie-breakers) are carried, but are no features.
    """
    present = [f for f in features if f in df.columns]
    carried = [c for c in extra if c in df.columns and c not in present]
    selected = df.select(F.col(key).alias("apt_id"), F.col(ts).alias("w_ts"), *present, *carried)
    return selected, present


def sanitise_names(df: DataFrame) -> DataFrame:
    """Runs of characters unfit for column names become one underscore."""
    return df.toDF(*[_BAD_NAME.sub("_", n) for n in df.columns])
