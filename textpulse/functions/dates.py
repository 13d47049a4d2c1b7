"""Time semantics. All functions assume the session runs in UTC (see ``session.use_utc``)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = {"Minute": "minute", "Hour": "hour", "Day": "day", "Week": "week"}
MESSAGE_TIME = "yyyy-MM-dd HH:mm:ss"


def moment(run_ts: str) -> Column:
    """A run's clock, bound once as a literal so that every table of the run agrees."""
    return F.lit(run_ts).cast("timestamp")


def safe_timestamp(created_at: Column | str, run_ts: str) -> Column:
    """Parsed time, or the run's clock for missing and unreadable values."""
    return F.coalesce(F.try_to_timestamp(created_at), moment(run_ts))


def to_second(ts: Column | str) -> Column:
    return F.date_trunc("second", ts)


def date_key(ts: Column | str) -> Column:
    """yyyyMMdd as a number, from the calendar parts (no text round trip)."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("bigint")


def calendar_parts(day: Column | str) -> dict[str, Column]:
    return {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}


def time_bucket(ts: Column | str, grain: str) -> Column:
    """Start of the minute, hour or day; a week is labelled by the Sunday that ends it."""
    start = F.date_trunc(GRAINS[grain], ts)
    return start + F.expr("INTERVAL 6 DAYS") if grain == "Week" else start


def within_days(first: date, last: date) -> Column:
    """Both days whole. The ``date_id`` half prunes partition folders, the other is exact."""
    keys = [int(d.strftime("%Y%m%d")) for d in (first, last)]
    after = last + timedelta(days=1)
    return (
        F.col("date_id").between(*keys)
        & (F.col("created_at") >= F.lit(first.isoformat()).cast("timestamp"))
        & (F.col("created_at") < F.lit(after.isoformat()).cast("timestamp"))
    )


def message_time(run_ts: str) -> Column:
    return F.date_format(moment(run_ts), MESSAGE_TIME)
