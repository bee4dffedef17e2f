"""Calendar parts and partition keys as native column expressions.

All of these stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the warehouse model.
OPEN_END_DATE = "9999-12-31"        # end_date of the current row version
DEFAULT_MARK = "1900-01-01 00:00:00"  # high-water mark before any completed extract
ADDRESS_BUCKET_START, ADDRESS_BUCKET_END, ADDRESS_BUCKET_STEP = 0, 1000, 100


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_of(ts) -> Column:
    """Calendar date of a timestamp."""
    return F.to_date(_c(ts))


def day_of_month(ts) -> Column:
    return F.dayofmonth(_c(ts)).cast("bigint")


def month_of_year(ts) -> Column:
    return F.month(_c(ts)).cast("bigint")


def week_sunday(ts) -> Column:
    """Week number 0..53 with weeks starting on Sunday.

    Days before the year's first Sunday are week 0. This is not the ISO week
    (``weekofyear``), which starts on Monday and can belong to the previous or
    next year.
    """
    d = _c(ts)
    return F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / F.lit(7)).cast("bigint")


def day_of_week(ts) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(_c(ts)).cast("bigint")


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts)).cast("bigint")


def is_weekend(ts) -> Column:
    return F.dayofweek(_c(ts)).isin(1, 7)


def month_start(ts) -> Column:
    """First day of the month as a date (storage partition key)."""
    return F.trunc(F.to_date(_c(ts)), "month")


def address_range_bucket(address_id) -> Column:
    """Range bucket of a surrogate address id: [0,100) -> 0 .. [900,1000) -> 9.

    Ids outside [0, 1000) share one overflow bucket, -1.
    """
    a = _c(address_id)
    inside = (a >= ADDRESS_BUCKET_START) & (a < ADDRESS_BUCKET_END)
    return F.when(inside, F.floor(a / F.lit(ADDRESS_BUCKET_STEP)).cast("bigint")) \
        .otherwise(F.lit(-1).cast("bigint"))


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (truncated toward zero); null in, null out.

    Computed as the zone-less interval ``end - start``: ``timestamp_diff``
    would first place TIMESTAMP_NTZ values in the session time zone and lose
    or gain an hour across a daylight-saving change.
    """
    return (_c(end) - _c(start)).cast("interval second").cast("bigint")


def add_seconds(ts, seconds) -> Column:
    return F.timestamp_add("SECOND", _c(seconds), _c(ts))
