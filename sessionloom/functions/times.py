"""Time expressions.  Days and hours are those of the session time zone; pin it to UTC
(``spark.sql.session.timeZone``) for results that do not depend on where a job runs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"

TIME_FIELDS = ("year", "month", "day", "hour", "minute", "second", "millisecond")


_USUAL = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\z"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_time(value: Column | str, pattern: str = TIME_FORMAT) -> Column:
    """Text to timestamp; malformed text fails the query (ANSI mode).

    Text in exactly the usual format takes Spark's own cast, several times faster than a
    pattern parser; anything else goes through the strict pattern, which refuses it.
    """
    value = _col(value)
    strict = F.to_timestamp(value, pattern)
    if pattern != TIME_FORMAT:
        return strict
    return F.when(value.rlike(_USUAL), value.cast("timestamp")).otherwise(strict)


def required_time(value: Column | str) -> Column:
    """As ``parse_time``, but a missing time fails as a malformed one does.

    The last alternative is never reached.  It tells the optimizer that the column holds no
    nulls, so joins on what is derived from it add no null filters, which would parse every
    time twice and keep equal shuffles from being shared.
    """
    missing = F.raise_error(F.lit("action time is missing")).cast("timestamp")
    return F.coalesce(parse_time(value), missing, F.timestamp_seconds(F.lit(0)))


def to_millis(value: Column | str, pattern: str = TIME_FORMAT) -> Column:
    return F.unix_millis(parse_time(value, pattern))


def from_millis(millis: Column | str, pattern: str = TIME_FORMAT) -> Column:
    return F.date_format(F.timestamp_millis(_col(millis)), pattern)


def time_field(millis: Column | str, field: str) -> Column:
    """One field of an epoch-millisecond time; months from 1, hours 0 to 23."""
    if field not in TIME_FIELDS:
        raise ValueError(f"unknown time field {field!r}, expected one of {TIME_FIELDS}")
    millis = _col(millis)
    if field == "millisecond":
        return F.pmod(millis, F.lit(1000)).cast("int")
    return F.extract(F.lit(field), F.timestamp_millis(millis)).cast("int")


def _tolerant(value: Column | str) -> Column:
    return F.try_to_timestamp(_col(value), F.lit(TIME_FORMAT))


def is_before(first: Column | str, second: Column | str) -> Column:
    """False also where either text is no time."""
    return F.coalesce(_tolerant(first) < _tolerant(second), F.lit(False))


def is_after(first: Column | str, second: Column | str) -> Column:
    return F.coalesce(_tolerant(first) > _tolerant(second), F.lit(False))


def seconds_between(first: Column | str, second: Column | str) -> Column:
    """``first - second`` in seconds; 0 where either is no time or an int cannot hold it."""
    seconds = F.unix_seconds(_tolerant(first)) - F.unix_seconds(_tolerant(second))
    fits = seconds.between(-(2**31), 2**31 - 1)
    return F.when(fits, seconds).otherwise(0).cast("int")


def date_hour_key(value: Column | str) -> Column:
    """``2024-01-01 09:02:03`` to ``2024-01-01_09``."""
    parts = F.split(_col(value), " ")
    return F.concat(parts[0], F.lit("_"), F.split(parts[1], ":")[0])


def minute_key(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyyMMddHHmm")


def today() -> Column:
    return F.date_format(F.current_date(), DATE_FORMAT)


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_FORMAT)
