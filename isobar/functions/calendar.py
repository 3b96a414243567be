"""Date attributes and the keys derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_BITS = 5
LOCATION_BITS = 27


def day_of_week(date: Column) -> Column:
    """0 is Sunday, 6 is Saturday."""
    return F.dayofweek(date) - 1


def is_weekend(date: Column) -> Column:
    return F.coalesce(day_of_week(date).isin(0, 6), F.lit(False))


def date_id(date: Column) -> Column:
    """yyyymmdd: unique, in date order, and needs no agreement between tasks."""
    return (F.year(date) * 10_000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def fact_id(date: Column, location: Column, hour: Column) -> Column:
    """The natural key packed into one BIGINT, the same on every rerun; a key that does not fit fails."""
    fits = location.between(0, 2**LOCATION_BITS - 1) & hour.between(0, 2**HOUR_BITS - 1)
    message = F.concat_ws(" ", F.lit("No fact id for location and hour"), location, hour)
    packed = (
        F.shiftleft(date.cast("bigint"), LOCATION_BITS + HOUR_BITS)
        .bitwiseOR(F.shiftleft(location.cast("bigint"), HOUR_BITS))
        .bitwiseOR(hour.cast("bigint"))
    )
    return F.when(~fits, F.raise_error(message)).otherwise(packed)
