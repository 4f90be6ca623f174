"""Time parsing and calendar parts. Day of week is Sunday = 1 .. Saturday = 7."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(col) -> Column:
    """Accepts '2026-08-25 10:30:00', '2026-08-25T10:30:00', a fraction and a trailing Z. Anything else is NULL, also a
    bare date or year and a zone offset, which a time without a zone cannot hold."""
    raw = F.trim(_col(col))
    plain = F.when(F.endswith(raw, F.lit("Z")), F.rtrim(raw, F.lit("Z"))).otherwise(raw)
    return F.when(raw.rlike(_TIMESTAMP), plain.try_cast("timestamp_ntz"))


def calendar_parts(col) -> dict[str, Column]:
    day = F.to_date(_col(col))
    return {
        "ride_date": day,
        "ride_hour": F.hour(_col(col)),
        "day_of_week": F.dayofweek(day),
        "month": F.month(day),
        "year": F.year(day),
    }


def is_weekend(col) -> Column:
    return F.dayofweek(_col(col)).isin(1, 7)


def _whole(unit: str, start, end) -> Column:
    # Times without a zone are subtracted as they are: no session time zone, no daylight saving.
    span = _col(end) - _col(start)
    hours = F.extract(F.lit("DAY"), span) * 24 + F.extract(F.lit("HOUR"), span)
    return (hours if unit == "HOUR" else hours * 60 + F.extract(F.lit("MINUTE"), span)).cast("bigint")


def minutes_between(start, end) -> Column:
    """Whole minutes; NULL when either side is NULL."""
    return _whole("MINUTE", start, end)


def hours_between(start, end) -> Column:
    return _whole("HOUR", start, end)


def utc_instant(col) -> Column:
    """A time without a zone, read as UTC."""
    return F.concat(_col(col).cast("string"), F.lit("Z")).cast("timestamp")


def utc_wall_clock(col) -> Column:
    """The inverse of `utc_instant`, whatever the session time zone."""
    seconds = (F.unix_micros(_col(col)).cast("decimal(24,0)") / F.lit(1000000)).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def month_start(col) -> Column:
    return F.trunc(F.to_date(_col(col)), "month")
