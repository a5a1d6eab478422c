"""Time expressions: reference time, ages, and the text forms used on the wire."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = Column | datetime | str | None


def as_of_column(as_of: AsOf) -> Column:
    """The reference time of a rule: a fixed time, a per-row column, or now."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(as_of).cast("timestamp")


def age_seconds(as_of: Column, ts: Column) -> Column:
    """Whole seconds between the second of ``ts`` and the second of ``as_of``."""
    return F.unix_seconds(as_of) - F.unix_seconds(ts.cast("timestamp"))


def ingest_date(as_of: AsOf = None) -> Column:
    return F.to_date(as_of_column(as_of))


def date_literal(value: date | str) -> Column:
    return F.lit(value).cast("date")


def rfc3339_nano(ts: Column) -> Column:
    """UTC text with a fraction only as long as needed (session zone must be UTC)."""
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.?0+$", ""), F.lit("Z"))


def rfc3339(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def truncate_to_millis(ts: Column) -> Column:
    return F.timestamp_millis(F.unix_millis(ts))
