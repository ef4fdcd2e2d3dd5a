"""Date expressions: look-back windows, period bins, text parsing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerspark.config import FREQUENCIES


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime, date or ISO text. Built from
    text, so neither the driver's nor the session's time zone shifts it."""
    if isinstance(value, dt.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def _ts(value) -> Column:
    return value if isinstance(value, Column) else ntz_literal(value)


def lookback(c, as_of, days: int, midnight: bool = False) -> Column:
    """``c >= as_of - days``. ``midnight`` reproduces CURRENT_DATE() (Snowflake);
    otherwise the time of day of ``as_of`` is kept (T-SQL GETDATE())."""
    start = _ts(as_of)
    if midnight:
        start = F.date_trunc("day", start).cast("timestamp_ntz")
    return _c(c) >= start - F.make_interval(days=F.lit(days))


def closed_window(c, start, end) -> Column:
    """``c BETWEEN start AND end`` (the date_parameters tuple)."""
    return _c(c).between(_ts(start), _ts(end))


def month_start(year, month) -> Column:
    """``YEAR-MONTH-01`` as TIMESTAMP_NTZ."""
    return F.make_timestamp_ntz(_c(year), _c(month), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def bin_start(c, freq: str) -> Column:
    """Left-labelled period bin of a timestamp (h, D, MS, QS, YS), built from its fields: no time zone takes part, so bins do
    not move in a daylight-saving gap."""
    unit, t = FREQUENCIES[freq][0], _c(c).cast("timestamp_ntz")
    month = {"year": F.lit(1), "quarter": (F.quarter(t) - 1) * 3 + 1}.get(unit, F.month(t))
    day = F.dayofmonth(t) if unit in ("day", "hour") else F.lit(1)
    hour = F.hour(t) if unit == "hour" else F.lit(0)
    return F.make_timestamp_ntz(F.year(t), month, day, hour, F.lit(0), F.lit(0))


def bin_number(start, freq: str) -> Column:
    """The number of a period bin, given its start (``bin_start``): consecutive bins have consecutive numbers."""
    unit, t = FREQUENCIES[freq][0], _c(start)
    months = F.year(t) * 12 + F.month(t) - 1
    days = F.unix_date(t.cast("date"))
    return {"hour": days * 24 + F.hour(t), "day": days, "month": months, "quarter": F.floor(months / 3), "year": F.year(t)}[unit].cast("long")


def bin_of_number(number, freq: str) -> Column:
    """The start of a period bin, given its number."""
    unit, n = FREQUENCIES[freq][0], _c(number)
    if unit in ("hour", "day"):
        day = F.date_from_unix_date((F.floor(n / 24) if unit == "hour" else n).cast("int"))
        hour = F.pmod(n, F.lit(24)).cast("int") if unit == "hour" else F.lit(0)
        return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), hour, F.lit(0), F.lit(0))
    months = n * {"month": 1, "quarter": 3, "year": 12}[unit]
    return F.make_timestamp_ntz(F.floor(months / 12).cast("int"), (F.pmod(months, F.lit(12)) + 1).cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def parse_timestamp(c, formats) -> Column:
    """First format that parses, as TIMESTAMP_NTZ; NULL when none does (never
    raises). ``try_to_timestamp`` only tests validity; the value comes from
    ``to_timestamp_ntz``, which no time zone shifts (a midnight inside a
    daylight-saving gap stays midnight)."""
    text = _c(c).cast("string")
    return F.coalesce(*[F.when(F.try_to_timestamp(text, F.lit(f)).isNotNull(),
                               F.to_timestamp_ntz(text, F.lit(f))) for f in formats])
