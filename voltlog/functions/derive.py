"""Columns derived from a valid event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_date(ts: Column) -> Column:
    return F.to_date(ts)


def event_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def is_moving(speed: Column) -> Column:
    return speed > 1


def is_charging(state: Column) -> Column:
    return F.lower(state) == "charging"


def battery_band(soc: Column) -> Column:
    return (
        F.when(soc <= 20, "critical").when(soc <= 50, "low").when(soc <= 80, "normal").otherwise("high")
    )


def iso_utc(ts: Column) -> Column:
    """ISO 8601 text in UTC; the fraction is written only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    fraction = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.concat(whole, F.coalesce(fraction, F.lit("")), F.lit("Z"))
