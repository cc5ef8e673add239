"""Event-time helpers. Zone-less times are read in the session zone, which is UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"  # fixed value


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970; fractions are cut off."""
    return F.unix_seconds(ts.cast("timestamp"))


def parse_event_time(text: Column, *, allow_fraction: bool = False) -> Column:
    """Zone-less time of an ISO string, NULL if it does not match."""
    fmt = EVENT_TIME_FORMAT + ("[.SSSSSS][.SSS]" if allow_fraction else "")
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def day_of(ts: Column, fallback: Column) -> Column:
    """Partition value yyyy-MM-dd of ``ts``, or of ``fallback`` when ``ts`` is NULL."""
    return F.coalesce(ts.cast("date"), fallback.cast("date")).cast("string")


def days_before(as_of: dt.date | str | None, days: int) -> Column:
    """Partition value ``days`` days before ``as_of`` (default: today); folds to a literal."""
    base = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return F.date_format(F.date_sub(base, days), "yyyy-MM-dd")
