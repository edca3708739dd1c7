"""Times and dates of the feeds; everything is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rbn_time(c: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS``, with or without ``+00``; null if it isn't one."""
    return F.try_to_timestamp(F.regexp_replace(c, r"\+00$", ""), F.lit("yyyy-MM-dd HH:mm:ss"))


def cabrillo_time(date: Column, time: Column) -> Column:
    """Minute of a contact: trailing Z dropped, cut to four digits, zeros in front; ISO or US date; null if bad."""
    hhmm = F.lpad(F.left(F.regexp_replace(time, r"[Zz]+$", ""), F.lit(4)), 4, "0")
    text = F.concat_ws(" ", date, hhmm)
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HHmm")), F.try_to_timestamp(text, F.lit("MM/dd/yyyy HHmm")))


def mid_month(c: Column) -> Column:
    """The 15th of a ``YYYY-MM`` month between 1900 and 2100; null otherwise."""
    year, month = F.substring(c, 1, 4).try_cast("int"), F.substring(c, 6, 2).try_cast("int")
    good = c.rlike(r"^\d{4}-\d{2}$") & year.between(1900, 2100) & month.between(1, 12)
    return F.when(good, F.make_date(F.when(good, year).otherwise(2000), F.when(good, month).otherwise(1), F.lit(15)))


def plausible(y: Column, m: Column, d: Column) -> Column:
    return F.coalesce(y.between(1900, 2100) & m.between(1, 12) & d.between(1, 31), F.lit(False))


def civil_date(y: Column, m: Column, d: Column) -> Column:
    """The date, with days past the month's end counted on (31 February is 3 March); null if implausible."""
    good = plausible(y, m, d)
    first = F.make_date(F.when(good, y).otherwise(2000), F.when(good, m).otherwise(1), F.lit(1))
    return F.when(good, F.date_add(first, F.when(good, d).otherwise(1) - 1))


def clamp_1900(c: Column) -> Column:
    return F.greatest(c, F.lit("1900-01-01").cast("date"))


def bucket3h(seconds: Column) -> Column:
    """Start of the three-hour interval, in epoch seconds."""
    return seconds - F.pmod(seconds, F.lit(10800))


def date_key(iso: Column) -> Column:
    """``YYYY-MM-DD`` of an ISO text."""
    return F.substring(iso, 1, 10)


def hour_key(iso: Column) -> Column:
    return F.substring(iso, 12, 2).try_cast("int")
