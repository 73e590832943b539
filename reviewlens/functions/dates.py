"""Date expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_epoch(seconds: Column) -> Column:
    """Unix seconds as a zone-less timestamp."""
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        zero, zero, zero, seconds
    )


def month_start(time: Column) -> Column:
    return F.trunc(F.to_date(time), "month")


def day_of_week(time: Column) -> Column:
    """Monday is 0."""
    return F.weekday(time)
