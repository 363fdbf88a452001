"""Wall-clock time. Values carry no zone (TIMESTAMP_NTZ), so DST gaps of the session zone cannot move them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(c: Column) -> Column:
    """``yyyy-MM-dd`` text to date, else NULL."""
    return F.when(c.rlike(r"^\d{4}-\d\d-\d\d$"), c.try_cast("date"))


def compact_date(c: Column) -> Column:
    """``yyyyMMdd`` text to date, else NULL."""
    dashed = F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return F.when(c.rlike(r"^\d{8}$"), dashed.try_cast("date"))


def pad_hhmm(c: Column) -> Column:
    """Left-pad a clock text to four characters (longer text is cut to four)."""
    return F.lpad(c.cast("string"), 4, "0")


def wall_clock(date: Column, hhmm: Column) -> Column:
    """Date + ``HHmm`` text to TIMESTAMP_NTZ; NULL for ``2400`` or anything that is no clock time."""
    clock = pad_hhmm(hhmm)
    text = F.concat(
        date.cast("string"), F.lit(" "), F.substring(clock, 1, 2), F.lit(":"), F.substring(clock, 3, 2)
    )
    return F.when(clock.rlike(r"^([01]\d|2[0-3])[0-5]\d$"), text.try_cast("timestamp_ntz"))


def add_minutes(ts: Column, minutes: Column) -> Column:
    """``ts`` plus minutes, cut to whole seconds; keeps the timestamp type. NULL where the sum leaves the calendar."""
    seconds = (minutes.cast("double") * 60).try_cast("bigint").try_cast("decimal(18,6)")
    return F.try_add(ts, F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds))


def add_hours(ts: Column, hours: Column | int) -> Column:
    """``ts`` plus (or minus) whole hours."""
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return F.timestamp_add("HOUR", hours, ts)


def micros(ts: Column, zoneless: bool) -> Column:
    """Microseconds since 1970 as a long, for both timestamp types.

    A zoneless time is measured as an interval: ``timestampdiff`` and ``unix_micros`` would read it in the
    session zone and move times inside a DST gap.
    """
    if not zoneless:
        return F.unix_micros(ts)
    since = (ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second")
    return (since.cast("decimal(20,6)") * 1_000_000).cast("bigint")


def month(c: Column) -> Column:
    """``yyyy-MM`` of a date or timestamp."""
    return F.date_format(c.cast("date"), "yyyy-MM")  # as a date no session zone can move it
