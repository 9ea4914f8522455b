"""Date parsing and formatting used by the file layouts and the reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_dmy(col: Column) -> Column:
    """``dd-mm-yy`` text to date, null when the text has another shape.

    Two-digit years 69-99 belong to the 1900s, 00-68 to the 2000s.
    """
    text = col.cast("string")
    shaped = F.when(text.rlike(r"^\d{1,2}-\d{1,2}-\d{2}$"), text)
    year = F.substring_index(shaped, "-", -1)
    century = F.when(year.cast("int") >= 69, F.lit("19")).otherwise(F.lit("20"))
    day_month = F.substring_index(shaped, "-", 2)
    return F.try_to_date(F.concat(day_month, F.lit("-"), century, year), "d-M-yyyy")


def parse_two_formats(col: Column) -> Column:
    """``dd-mm-yy`` first, ``yyyy-mm-dd`` second, else null."""
    text = col.cast("string")
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text)
    return F.coalesce(parse_dmy(col), F.try_to_date(iso, "yyyy-M-d"))


def week_of_year(col: Column) -> Column:
    """Week number with weeks starting on Sunday; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(col) - F.dayofweek(col) + 7) / 7).cast("int")


def in_lookback(date_col: Column, as_of: Column, days: int = 15) -> Column:
    """True for the last ``days`` calendar days, ``as_of`` included.

    A look-back of 15 days from an instant during ``as_of`` excludes the midnight
    15 days earlier, so the first day kept is ``as_of - 14``.
    """
    return (date_col >= F.date_sub(as_of, days - 1)) & (date_col <= as_of)


def local_today(utc_now: Column | None = None, offset: str = "-06:00") -> Column:
    """Calendar date at a fixed offset from UTC."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()) if utc_now is None else utc_now
    return F.to_date(F.from_utc_timestamp(now, offset))


def to_dmy(col: Column) -> Column:
    """Date to ``dd-mm-yy``, the name of a scrape folder."""
    return F.date_format(col, "dd-MM-yy")


def to_ydm(col: Column) -> Column:
    """Date to ``yyyy-dd-mm``, the suffix of a price file (day before month)."""
    return F.date_format(col, "yyyy-dd-MM")


def to_ddmmyyyy(col: Column) -> Column:
    """Date to ``ddmmyyyy``, the name of an older scrape folder."""
    return F.date_format(col, "ddMMyyyy")


def as_date(value: str | dt.date) -> dt.date:
    """Job argument to date: a date, ``dd-mm-yy`` or ``yyyy-mm-dd``."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    for fmt in ("%d-%m-%y", "%Y-%m-%d"):
        try:
            return dt.datetime.strptime(value, fmt).date()
        except ValueError:
            continue
    raise ValueError(f"not a date: {value!r}")
