"""Epoch and calendar expressions.

Raw nanosecond columns stay ``bigint``: Spark time stamps stop at microseconds, and a predicate on the raw
column is what reaches the Parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe import fixed

NS_PER_SECOND = 1_000_000_000
US_PER_DAY = 86_400_000_000
MILLIS_FLOOR = 1e10


def floor_div(value: Column, divisor: int) -> Column:
    """Integer division that rounds down for instants before 1970 too."""
    width = F.lit(divisor).cast("bigint")
    return F.call_function("div", value - F.pmod(value, width), width)


def day_start_ns(day: dt.date) -> int:
    """Nanoseconds since the epoch at UTC midnight of ``day``."""
    return (day - dt.date(1970, 1, 1)).days * 86_400 * NS_PER_SECOND


def lookback_cutoff_ns(as_of: dt.date, days: int = fixed.LOOKBACK_DAYS) -> int:
    """First nanosecond of the lookback window that ends at ``as_of``; a plain literal, so it is pushed down."""
    return day_start_ns(as_of - dt.timedelta(days=days))


def utc_date(ns: Column) -> Column:
    return F.date_from_unix_date(floor_div(ns, 86_400 * NS_PER_SECOND).cast("int"))


def utc_timestamp(ns: Column) -> Column:
    return F.timestamp_micros(floor_div(ns, 1000))


def local_micros(ns: Column, zone: str = fixed.MARKET_ZONE) -> Column:
    """Wall-clock microseconds in ``zone`` (daylight saving included), counted as if the wall clock were UTC."""
    return F.unix_micros(F.from_utc_timestamp(utc_timestamp(ns), zone))


def local_date(ns: Column, zone: str = fixed.MARKET_ZONE) -> Column:
    return F.date_from_unix_date(floor_div(local_micros(ns, zone), US_PER_DAY).cast("int"))


def _clock_ns(clock: str) -> int:
    hours, minutes, seconds = (int(part) for part in clock.split(":"))
    return (hours * 3600 + minutes * 60 + seconds) * NS_PER_SECOND


def in_trading_hours(
    ns: Column,
    opens: str = fixed.SESSION_OPEN,
    closes: str = fixed.SESSION_CLOSE,
    zone: str = fixed.MARKET_ZONE,
) -> Column:
    """True from ``opens`` to ``closes`` in ``zone``, both ends included, exact to the nanosecond."""
    of_day = F.pmod(local_micros(ns, zone), F.lit(US_PER_DAY)) * 1000 + F.pmod(ns, F.lit(1000))
    return of_day.between(_clock_ns(opens), _clock_ns(closes))


def iso_utc(text: Column) -> Column:
    """ISO text with or without an offset as ``yyyy-MM-ddTHH:mm:ssZ`` in UTC; unreadable text gives null."""
    return F.date_format(text.try_cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def date_part(text: Column) -> Column:
    """Text before ``T`` of an ISO instant, the whole value when there is none, ``N/A`` when absent."""
    return F.substring_index(F.coalesce(text, F.lit("N/A")), "T", 1)


def window_start(as_of: dt.date, months: Column) -> Column:
    """``months`` calendar months before ``as_of``, clamped to the end of shorter months."""
    return F.add_months(F.lit(as_of), -months)


def standardize_timestamp(df: DataFrame, column: str, rule: str = "row") -> DataFrame:
    """Turn ``column`` into a UTC ``timestamp`` column of that name.

    Time stamps are kept. Text is parsed, unreadable text gives null. Numbers above 1e10 are epoch
    milliseconds. ``rule="column"`` decides that once from the column's maximum (one aggregate, one row to the
    driver); ``rule="row"`` decides it per value. Other numbers are null.
    """
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        parsed = value
    elif isinstance(kind, T.NumericType):
        if rule == "column":
            highest = df.agg(F.max(column)).first()[0]
            millis = F.lit(highest is not None and highest > MILLIS_FLOOR)
        elif rule == "row":
            millis = value > MILLIS_FLOOR
        else:
            raise ValueError(f"unknown rule {rule!r}")
        parsed = F.when(millis, F.timestamp_millis(value.cast("bigint")))
    else:
        parsed = F.try_to_timestamp(value.cast("string"))
    others = [F.col(name) for name in df.columns if name != column]
    return df.select(*others, parsed.alias("timestamp"))
