"""Date and time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import _c, ColumnOrName

# Fixed value: day zero of spreadsheet serial dates (serial 44813 = 2022-09-09).
EXCEL_EPOCH = "1899-12-30"

# Fixed value: a leap year used to turn a day-of-year back into a calendar
# date, so that day 60 is 29 February.
LEAP_BASE = "2015-12-31"


def excel_date(col: ColumnOrName) -> Column:
    """Spreadsheet serial day number → date (X15); NULL for non-numbers."""
    n = _c(col).try_cast("int")
    return F.date_add(F.lit(EXCEL_EPOCH).cast("date"), n)


def day_fraction_seconds(col: ColumnOrName) -> Column:
    """Fraction of a day → whole seconds since midnight."""
    return F.round(_c(col).cast("double") * 86400).cast("long")


def seconds_to_hms(col: ColumnOrName) -> Column:
    """Seconds since midnight → ``HH:mm:ss`` text."""
    s = _c(col).cast("long")
    return F.format_string("%02d:%02d:%02d", (s / 3600).cast("long"),
                           ((s % 3600) / 60).cast("long"), s % 60)


def day_fraction(col: ColumnOrName) -> Column:
    """Fraction of a day → ``HH:mm:ss``."""
    return seconds_to_hms(day_fraction_seconds(col))


def parse_ts(col: ColumnOrName, pattern: str | None = None) -> Column:
    """Parse text to timestamp; unparsable → NULL."""
    c = _c(col)
    return F.try_to_timestamp(c, F.lit(pattern)) if pattern else F.try_to_timestamp(c)


def split_ts(col: ColumnOrName) -> tuple[Column, Column]:
    """Timestamp → (date, ``HH:mm:ss``)."""
    c = _c(col)
    return F.to_date(c), F.date_format(c, "HH:mm:ss")


def with_zone(col: ColumnOrName, tz: str) -> Column:
    """Interpret a local wall-clock time in ``tz`` and return the UTC instant."""
    return F.to_utc_timestamp(_c(col), tz)


def day_of_year(col: ColumnOrName) -> Column:
    return F.dayofyear(_c(col))


def doy_to_date(col: ColumnOrName) -> Column:
    """Day-of-year → date in a leap year, for plotting climatologies."""
    return F.date_add(F.lit(LEAP_BASE).cast("date"), _c(col).cast("int"))


def ymd_parts(col: ColumnOrName) -> tuple[Column, Column, Column]:
    """ISO date → year, month, day texts."""
    c = F.date_format(_c(col), "yyyy-MM-dd")
    return F.split_part(c, F.lit("-"), F.lit(1)), F.split_part(c, F.lit("-"), F.lit(2)), \
        F.split_part(c, F.lit("-"), F.lit(3))
