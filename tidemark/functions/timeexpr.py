"""Event-time column expressions.

Instants are ``timestamp_ntz`` values holding UTC wall time. Every helper here
is independent of ``spark.sql.session.timeZone``. ``date_trunc``,
``timestamp_diff`` and ``date_format`` silently turn a ``timestamp_ntz`` into a
session-zone ``timestamp`` (an hour off around a DST change), so they are not
used on instants; field extraction (``hour``, ``second`` ...), ``unix_date``,
``timestamp_add``, ``convert_timezone`` and casts to text are zone-free.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import DEFAULT_ZONE

# The text form of an event time (its pattern is what text must match).
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
TEXT_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz(value: str | _dt.datetime | Column) -> Column:
    """A ``timestamp_ntz`` literal from text or a naive datetime (no zone applied)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.expr(f"TIMESTAMP_NTZ'{value}'")


def epoch_seconds(ts: Column) -> Column:
    """Epoch seconds (bigint) of a UTC ``timestamp_ntz``; the fraction is dropped."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def event_instant(ts: Column) -> Column:
    """A zone-free ``timestamp_ntz`` as the ``timestamp`` of the same UTC wall time, which watermarks need."""
    fraction = (F.date_part(F.lit("SECONDS"), ts) * 1_000_000 % 1_000_000).cast("bigint")
    return F.timestamp_micros(epoch_seconds(ts) * 1_000_000 + fraction)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, both truncated to seconds first."""
    return epoch_seconds(end) - epoch_seconds(start)


def from_epoch(epoch: Column) -> Column:
    """UTC ``timestamp_ntz`` of epoch seconds."""
    return F.timestamp_add("SECOND", epoch.cast("bigint"), F.expr(_EPOCH))


def utc_to_local(ts: Column, zone: str = DEFAULT_ZONE) -> Column:
    """UTC wall time to wall time in ``zone`` (both ``timestamp_ntz``)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def local_to_utc(ts: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Relabel a naive local wall time as an instant (reference: from_datetime_local)."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)


def convert_zone(ts: Column, from_zone: str, to_zone: str) -> Column:
    return F.convert_timezone(F.lit(from_zone), F.lit(to_zone), ts)


def to_seconds(ts: Column) -> Column:
    """Truncate an instant to whole seconds (the reference keeps seconds only)."""
    return from_epoch(epoch_seconds(ts))


def format_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a ``timestamp_ntz`` (seconds precision)."""
    return to_seconds(ts).cast("string")


def local_text(ts: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Instant -> local text in ``zone`` (reference: str(EventTime))."""
    return format_text(utc_to_local(ts, zone))


def is_valid_text(text: Column) -> Column:
    """True when ``text`` has the strict event-time form and is a real date-time."""
    return F.coalesce(text.rlike(TEXT_PATTERN) & text.try_cast("timestamp_ntz").isNotNull(), F.lit(False))


def parse_local_text(text: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Local text -> UTC instant; null for text that is not a valid event time."""
    wall = F.when(is_valid_text(text), text.try_cast("timestamp_ntz"))
    return local_to_utc(wall, zone)


def report_time(ts: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Report form ``M/d/yy h:mm AM`` of an instant, in ``zone``."""
    local = utc_to_local(ts, zone)
    h = F.hour(local)
    h12 = F.when(h % 12 == 0, F.lit(12)).otherwise(h % 12)
    ampm = F.when(h < 12, F.lit("AM")).otherwise(F.lit("PM"))
    return F.format_string("%d/%d/%02d %d:%02d %s",
                           F.month(local), F.dayofmonth(local), F.year(local) % 100,
                           h12, F.minute(local), ampm)
