"""Dates and times as the vendors write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"


def plain_date(c: Column) -> Column:
    """``yyyy-MM-dd`` as a calendar date, null if it is none; no zone is involved."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


def stamp_date(c: Column) -> Column:
    """Calendar date that an RFC 3339 text begins with."""
    return F.try_to_date(F.left(c, F.lit(10)), "yyyy-MM-dd")


def new_york_date(utc_midnight: Column) -> Column:
    """Date in New York of a UTC instant; midnight falls on the day before."""
    return F.convert_timezone(F.lit("UTC"), F.lit(NEW_YORK), utc_midnight.cast("timestamp_ntz")).cast("date")


def close_time(stamp: Column) -> Column:
    """Time of day in New York of a close given as an RFC 3339 text, 16:00:00 where none is given."""
    # The cast gives the wall time of the session's zone, from which the conversion starts.
    at = F.convert_timezone(None, F.lit(NEW_YORK), F.try_to_timestamp(stamp).cast("timestamp_ntz"))
    return F.coalesce(F.date_format(at, "HH:mm:ss"), F.lit("16:00:00"))


def compact_date(c: Column) -> Column:
    """``yyyyMMdd`` or ``yyyyMM`` as ``yyyy-MM-dd``, other texts unchanged."""
    day = F.when(c.rlike(r"^\d{8}$"), F.try_to_date(c, "yyyyMMdd"))
    month = F.when(c.rlike(r"^\d{6}$"), F.try_to_date(F.concat(c, F.lit("01")), "yyyyMMdd"))
    return F.coalesce(F.date_format(F.coalesce(day, month), "yyyy-MM-dd"), c)


def iso_micros(ts: Column) -> Column:
    """Timestamp as a text with microseconds and Z, '' for null."""
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit(""))


def until(last: Column, as_of: Column) -> Column:
    """``present``, or month and year where the last observation is more than 30 days before ``as_of``."""
    return F.when(F.datediff(as_of, last) > 30, F.date_format(last, "MMM yyyy")).otherwise("present")
