"""Date and time column helpers.

Time-dependent operators never read the wall clock: they take an
``as_of`` date so that results are reproducible and comparable with the
oracle.  Timestamps are zone-less (``timestamp_ntz``) and the session
time zone is UTC.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = "str | datetime.date"


def as_of_lit(as_of) -> Column:
    """``as_of`` (date or ISO string) as a DATE literal."""
    if isinstance(as_of, _dt.date):
        as_of = as_of.isoformat()
    return F.to_date(F.lit(str(as_of)))


def month_start(ts: Column) -> Column:
    """``DATE_TRUNC('month', x)`` as a zone-less timestamp (date or timestamp input)."""
    return F.date_trunc("month", ts.cast("timestamp_ntz")).cast("timestamp_ntz")


def day_of(ts: Column) -> Column:
    """``x::date``."""
    return F.to_date(ts)


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days ``later - earlier`` of two dates (BIGINT)."""
    return F.datediff(later, earlier).cast("bigint")


def length_of_stay(discharge: Column, admitted_at: Column, as_of=None) -> Column:
    """Days from the admission day to discharge; open stays run to ``as_of`` when given."""
    end = discharge if as_of is None else F.coalesce(discharge, as_of_lit(as_of))
    return days_between(end, day_of(admitted_at))


def epoch_seconds(ts: Column) -> Column:
    """``EXTRACT(EPOCH FROM x)`` in UTC, as DOUBLE."""
    return F.unix_timestamp(ts.cast("timestamp_ntz")).cast("double")


def midnight(d: Column) -> Column:
    """A DATE as the zone-less timestamp at its midnight."""
    return d.cast("timestamp_ntz")
