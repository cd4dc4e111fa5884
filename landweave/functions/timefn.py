"""Time expressions: clipped search windows, season parts, formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts(c: Column | str) -> Column:
    """A timestamp from a timestamp of either kind."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def clipped_window(center: Column, start: Column, end: Column, days: int) -> tuple[Column, Column]:
    """center -/+ days, cut to [start, end]."""
    step = F.expr(f"INTERVAL '{days}' DAY")
    return F.greatest(center - step, start), F.least(center + step, end)


def iso_seconds(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_range(start: Column, end: Column) -> Column:
    return F.concat_ws("/", iso_seconds(start), iso_seconds(end))


def parse_time(text: Column) -> Column:
    """Timestamps with or without fractions and zone, and plain dates; null where none fits."""
    formats = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSSX", "yyyy-MM-dd'T'HH:mm:ss.SSSX", "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyyMMdd")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def apart(a: Column, b: Column) -> Column:
    """Microseconds between two timestamps."""
    return F.abs(F.unix_micros(a) - F.unix_micros(b))


def quarter(t: Column) -> Column:
    """Quarter of the year; the year itself is not regarded."""
    return F.quarter(t).cast("bigint")


def day_stamp(t: Column) -> Column:
    return F.date_format(t, "yyyyMMdd")
