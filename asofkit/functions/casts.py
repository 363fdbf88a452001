"""Lenient typing of all-string columns. Nothing here raises under ANSI mode: bad text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that stand for "no value" and for a trace of precipitation.
MISSING = ("", "M")
TRACE = "T"

# What counts as a number in text.
_WHOLE = r"^\s*([+-]?\d+)(\.\d*)?\s*$"
_REAL = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?[fd]?|nan|inf|infinity)\s*$"
_BITS = {"tinyint": 8, "smallint": 16, "int": 32}


def null_if_missing(c: Column) -> Column:
    """NULL when the trimmed text is empty or a missing mark, else the text unchanged."""
    return F.when(~F.trim(c).isin(*MISSING), c)


def null_if_trace(c: Column) -> Column:
    """F8: NULL for a trace amount."""
    return F.when(F.trim(c) != TRACE, c)


def whole(c: Column) -> Column:
    """Text to bigint, a decimal part cut off; NULL when it is no plain number.

    Such texts, missing and trace marks among them, never reach the cast: a cast that fails inside costs far more
    than the pattern.
    """
    return F.nullif(F.regexp_extract(c, _WHOLE, 1), F.lit("")).try_cast("bigint")


def fit(value: Column, data_type: str) -> Column:
    """A bigint as it is or as a smaller type, NULL when it is out of range."""
    if data_type == "bigint":
        return value
    half = 1 << (_BITS[data_type] - 1)
    return F.when((value >= -half) & (value < half), value.cast(data_type))


def to_whole(c: Column, data_type: str) -> Column:
    """Text to tinyint/smallint/int/bigint. For several columns of a table use ``with_whole``."""
    return fit(whole(c), data_type)


def with_whole(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """C5 in place for several columns: parsed in one projection, fitted in a second, so each text is read once."""
    parsed = df.withColumns({f"_whole_{n}": whole(F.col(n)) for n in types})
    fitted = parsed.withColumns({n: fit(F.col(f"_whole_{n}"), t) for n, t in types.items()})
    return fitted.drop(*[f"_whole_{n}" for n in types])


def to_real(c: Column, data_type: str = "float") -> Column:
    """Text to float/double, NULL when it is no number."""
    return F.when(c.rlike(_REAL), c.try_cast(data_type))


def value_or(c: Column, default) -> Column:
    """The value, or a default of the same kind for NULL."""
    return F.coalesce(c, F.lit(default))


def is_set(flag: Column) -> Column:
    """does a 0/1 flag held as text equal one? NULL when the text is no number."""
    return to_real(flag, "double") == F.lit(1.0)
