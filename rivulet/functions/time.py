"""Time expressions that do not depend on the session time zone.

``utc_bucket`` (P3) turns epoch milliseconds into the table's partition
value. The reference formats the instant in UTC as ``yyyyMMdd-HHmm``; here it
is built with integer arithmetic on the epoch value, so it is right for
negative values, in DST gaps, and under any ``spark.sql.session.timeZone``
(``date_format`` would format in the session zone).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet.fixed import PARTITION_FORMAT

# Partition value format per grain; the minute grain is the reference's.
GRAIN_FORMATS = {
    "minute": PARTITION_FORMAT,
    "hour": "yyyyMMdd-HH",
    "day": "yyyyMMdd",
}

_MS_PER_DAY = 86_400_000
_MS_PER_MINUTE = 60_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_from_ntz(ts: Column | str) -> Column:
    """Epoch milliseconds (floored) of a ``TIMESTAMP_NTZ`` read as UTC.

    Goes through a zone-free day-time interval, so no session zone and no
    DST rule touches the value; sub-millisecond digits are floored, also
    before 1970.
    """
    since_epoch = _col(ts) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = since_epoch.cast("interval second").cast("decimal(20,6)")
    return F.floor(seconds * 1000).cast("bigint")


def epoch_ms_to_timestamp(ms: Column | str) -> Column:
    """Epoch milliseconds to a ``TIMESTAMP`` (needed by ``withWatermark``)."""
    return F.timestamp_millis(_col(ms))


def utc_bucket(ms: Column | str, grain: str = "minute") -> Column:
    """UTC time bucket of epoch milliseconds: ``yyyyMMdd[-HH[mm]]``."""
    if grain not in GRAIN_FORMATS:
        raise ValueError(f"grain must be one of {sorted(GRAIN_FORMATS)}, not {grain!r}")
    ms = _col(ms).cast("bigint")
    in_day = F.pmod(ms, F.lit(_MS_PER_DAY))  # 0 .. day-1, also for ms < 0
    # An exact multiple of a day divided by a day: exact in double arithmetic
    # for every |ms| < 2**53.
    day = ((ms - in_day) / F.lit(_MS_PER_DAY)).cast("int")
    # Casting a DATE to string is zone-free: yyyy-MM-dd.
    ymd = F.translate(F.date_from_unix_date(day).cast("string"), "-", "")
    if grain == "day":
        return ymd
    minute_of_day = (in_day / F.lit(_MS_PER_MINUTE)).cast("int")
    hh = F.lpad((minute_of_day / 60).cast("int").cast("string"), 2, "0")
    if grain == "hour":
        return F.concat(ymd, F.lit("-"), hh)
    mm = F.lpad((minute_of_day % 60).cast("string"), 2, "0")
    return F.concat(ymd, F.lit("-"), hh, mm)


def partition_key(event_time: Column | str = "event_time", grain: str = "minute") -> Column:
    """The table's partition value (P3): ``utc_bucket`` of the event time."""
    return utc_bucket(event_time, grain)
