"""The five tables of a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlog.functions import derive
from voltlog.schemas import FIELD_NAMES


def enriched_columns() -> list[Column]:
    return [
        *map(F.col, FIELD_NAMES),
        derive.event_date(F.col("event_ts")).alias("event_date"),
        derive.event_hour(F.col("event_ts")).alias("event_hour"),
        derive.is_moving(F.col("speed_mph")).alias("is_moving"),
        derive.is_charging(F.col("charging_state")).alias("is_charging"),
        derive.battery_band(F.col("battery_soc")).alias("battery_band"),
    ]


def enrich(events: DataFrame) -> DataFrame:
    return events.select(*enriched_columns())


# --- aggregates as states, which can be merged: sums and counts in place of means ---------------


def hourly_states(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("vin", "event_hour").agg(
        F.count("event_id").alias("events"),
        F.sum("speed_mph").alias("speed_sum"),
        F.count("speed_mph").alias("speed_count"),
        F.max("speed_mph").alias("max_speed_mph"),
        F.sum("battery_soc").alias("soc_sum"),
        F.count("battery_soc").alias("soc_count"),
        F.min("battery_soc").alias("min_battery_soc"),
        F.max("battery_temp_c").alias("max_battery_temp_c"),
        F.count_if("is_moving").alias("moving_events"),
        F.count_if("is_charging").alias("charging_events"),
        F.max("odometer_miles").alias("latest_odometer_miles"),
    )


def hourly_of(states: DataFrame) -> DataFrame:
    return states.select(
        "vin", "event_hour", "events", (F.col("speed_sum") / F.col("speed_count")).alias("avg_speed_mph"),
        "max_speed_mph", (F.col("soc_sum") / F.col("soc_count")).alias("avg_battery_soc"), "min_battery_soc",
        "max_battery_temp_c", "moving_events", "charging_events", "latest_odometer_miles",
    )


def hourly_metrics(enriched: DataFrame) -> DataFrame:
    return hourly_of(hourly_states(enriched))


def daily_states(enriched: DataFrame) -> DataFrame:
    """Trips and battery health share their key, so one shuffle serves both."""
    moving = lambda name: F.when(F.col("is_moving"), F.col(name))
    return enriched.groupBy("vin", "event_date").agg(
        F.count_if("is_moving").alias("moving_events"),
        F.min(moving("event_ts")).alias("first_event_ts"),
        F.max(moving("event_ts")).alias("last_event_ts"),
        F.min(moving("odometer_miles")).alias("start_odometer_miles"),
        F.max(moving("odometer_miles")).alias("end_odometer_miles"),
        F.sum(moving("speed_mph")).alias("speed_sum"),
        F.count(moving("speed_mph")).alias("speed_count"),
        F.max(moving("speed_mph")).alias("max_speed_mph"),
        F.count_if(F.col("is_moving") & F.col("autopilot_engaged")).alias("autopilot_events"),
        F.sum("battery_soc").alias("soc_sum"),
        F.count("battery_soc").alias("soc_count"),
        F.min("battery_soc").alias("min_battery_soc"),
        F.sum("battery_temp_c").alias("temp_sum"),
        F.count("battery_temp_c").alias("temp_count"),
        F.max("battery_temp_c").alias("max_battery_temp_c"),
        F.count_if("is_charging").alias("charge_events"),
    )


def daily_of(states: DataFrame) -> DataFrame:
    mean = lambda name: F.col(f"{name}_sum") / F.col(f"{name}_count")
    return states.select(
        "vin", "event_date", "moving_events", "first_event_ts", "last_event_ts", "start_odometer_miles",
        "end_odometer_miles", mean("speed").alias("avg_speed_mph"), "max_speed_mph", "autopilot_events",
        mean("soc").alias("avg_battery_soc"), "min_battery_soc", mean("temp").alias("avg_battery_temp_c"),
        "max_battery_temp_c", "charge_events",
        (F.col("end_odometer_miles") - F.col("start_odometer_miles")).alias("distance_miles"),
    )


def daily_metrics(enriched: DataFrame) -> DataFrame:
    return daily_of(daily_states(enriched))


def merged_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state per key out of several: extremes of extremes, sums of all other columns."""

    def merge(name: str) -> Column:
        if name.startswith(("min_", "first_", "start_")):
            return F.min(name)
        if name.startswith(("max_", "last_", "latest_", "end_")):
            return F.max(name)
        return F.sum(name)

    rest = [c for c in states.columns if c not in keys]
    return states.groupBy(*keys).agg(*[merge(c).alias(c) for c in rest]).select(*states.columns)


def trips_of(daily: DataFrame) -> DataFrame:
    return daily.where("moving_events > 0").select(
        "vin", "event_date", "first_event_ts", "last_event_ts", "start_odometer_miles",
        "end_odometer_miles", "avg_speed_mph", "max_speed_mph", "autopilot_events", "distance_miles",
    )


def battery_of(daily: DataFrame) -> DataFrame:
    return daily.select(
        "vin", "event_date", "avg_battery_soc", "min_battery_soc", "avg_battery_temp_c",
        "max_battery_temp_c", "charge_events",
    )


def moving_events(enriched: DataFrame) -> DataFrame:
    return enriched.where("is_moving")


def trip_metrics(enriched: DataFrame) -> DataFrame:
    return trips_of(daily_metrics(moving_events(enriched)))


def battery_health(enriched: DataFrame) -> DataFrame:
    return battery_of(daily_metrics(enriched))


def alerts(enriched: DataFrame) -> DataFrame:
    return enriched.where("event_type = 'alert'")


def build_tables(events: DataFrame) -> dict[str, DataFrame]:
    enriched = enrich(events)
    daily = daily_metrics(enriched)
    return {
        "telemetry_enriched": enriched,
        "vehicle_hourly_metrics": hourly_metrics(enriched),
        "trip_metrics": trips_of(daily),
        "battery_health": battery_of(daily),
        "alerts": alerts(enriched),
    }
