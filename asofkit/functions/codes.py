"""Features read out of coded sky and weather texts, as native column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two-letter weather codes that get a score column each.
WEATHER_CODES = (
    "BR", "DU", "DZ", "FG", "FU", "GR", "GS", "HZ", "IC", "PE", "PL", "PO", "RA", "SA",
    "SG", "SH", "SN", "SQ", "SS", "TS", "UP", "VA", "VC", "FZ", "BL", "DS", "DR", "FC",
)

# Cloud-cover prefixes that get a flag column each.
SKY_PREFIXES = ("OVC", "BKN", "SCT", "FEW", "VV")

# A layer height in hundreds of feet; an intensity sign and a two-letter code.
HEIGHT_PATTERN = r"(?<!/)(\d{3})(?!/)"
CODE_PATTERN = r"([+-]?)([A-Z]{2})"

# Weight of a light, a plain and a heavy phenomenon.
LIGHT, PLAIN, HEAVY = 1, 2, 4


def sky_altitudes(c: Column) -> Column:
    """All layer heights in feet, in text order; an empty array when there are none."""
    found = F.regexp_extract_all(c, F.lit(HEIGHT_PATTERN), F.lit(1))
    # "007" with two zeros is 700: a cast of the array, which is compiled, where a lambda would be interpreted
    feet = F.split(F.concat(F.array_join(found, "00,"), F.lit("00")), ",").cast("array<int>")
    return F.when(F.size(found) > 0, feet).otherwise(F.array().cast("array<int>"))


def token_count(c: Column) -> Column:
    """Number of blank-separated tokens; 0 for NULL, blank or the missing mark."""
    tokens = F.coalesce(F.regexp_count(c, F.lit(r"\S+")), F.lit(0))
    missing = (tokens == 1) & (F.btrim(c, F.lit(" \t\n\x0b\f\r")) == "M")
    return F.when(missing, 0).otherwise(tokens)


def has_token(c: Column, token: str) -> Column:
    """Substring test that is false, not NULL, on NULL."""
    return F.coalesce(c.contains(token), F.lit(False))


def mean_of(arr: Column) -> Column:
    """Mean of an int array as a double, NULL when empty."""
    few, n = 4, F.size(arr)
    # few elements, as nearly always, are added up in compiled code; the general sum is interpreted
    total = F.when(n <= few, reduce(lambda a, b: a + b, [F.coalesce(F.get(arr, F.lit(i)), F.lit(0)).cast("bigint") for i in range(few)])).otherwise(
        F.aggregate(arr, F.lit(0).cast("bigint"), lambda acc, x: acc + x))
    return F.when(n > 0, total / n)


def code_list(c: Column) -> Column:
    """X5, first half: the codes of a text from last to first, letters reversed, each followed by a digit, its weight.

    Tokens are taken left to right, so a code is never found across the border of two others; all else is a blank, which a
    plain code finds in the place of its sign.
    """
    tokens = F.regexp_replace(c, f"(?s){CODE_PATTERN}|.", " $1$2")
    return F.coalesce(F.translate(F.reverse(tokens), "-+ ", f"{LIGHT}{HEAVY}{PLAIN}"), F.lit(""))


def score_in(listed: Column, code: str) -> Column:
    """X5, second half: the score of one code in ``code_list``, its last one's if it is there more than once; 0 when it is absent.

    Nearly all codes are absent, which a plain search tells. Kept this small because 28 of them share one generated method,
    which the JVM only compiles below 8000 bytes.
    """
    turned = code[::-1]
    weight = F.ascii(F.substring(listed, F.instr(listed, turned) + len(code), F.lit(1))) - ord("0")
    return F.when(F.contains(listed, F.lit(turned)), weight).otherwise(0)


def weather_score(c: Column, code: str) -> Column:
    """Score of one code in a weather text. For many codes, hold ``code_list`` in a column first."""
    return score_in(code_list(c), code) if code in WEATHER_CODES else F.lit(0)
