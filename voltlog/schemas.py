"""Event contract and table schemas, stated as data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: the event contract, in declaration order -----------------
# name, kind, lower limit, upper limit. For text kinds the limits are lengths.


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    low: int | None = None
    high: int | None = None
    required: bool = True


FIELDS = (
    Field("event_id", "text", 8),
    Field("vin", "vin", 11, 17),
    Field("event_ts", "instant"),
    Field("ingest_ts", "instant"),
    Field("event_type", "word"),
    Field("latitude", "number", -90, 90),
    Field("longitude", "number", -180, 180),
    Field("speed_mph", "number", 0, 180),
    Field("battery_soc", "number", 0, 100),
    Field("battery_temp_c", "number", -40, 90),
    Field("odometer_miles", "number", 0),
    Field("charging_state", "text"),
    Field("gear", "text"),
    Field("autopilot_engaged", "flag"),
    Field("alert_code", "text", required=False),
    Field("software_version", "text"),
)
FIELD_NAMES = tuple(f.name for f in FIELDS)
EVENT_TYPES = ("telemetry", "charge", "alert")
# --- end of fixed values ------------------------------------------------------

_SPARK_TYPE = {
    "text": T.StringType(),
    "vin": T.StringType(),
    "word": T.StringType(),
    "instant": T.TimestampType(),
    "number": T.DoubleType(),
    "flag": T.BooleanType(),
}

EVENT = T.StructType([T.StructField(f.name, _SPARK_TYPE[f.kind]) for f in FIELDS])


_BY_NAME = {
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
}


def _struct(columns: str) -> T.StructType:
    """``"name type, ..."`` as a schema; Spark's own DDL parser needs a running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _BY_NAME[kind]) for name, kind in pairs])


# --- fixed values: columns of the curated tables and of the ledger -------------
ENRICHED = T.StructType(
    EVENT.fields
    + _struct(
        "event_date date, event_hour timestamp, is_moving boolean, "
        "is_charging boolean, battery_band string"
    ).fields
)
HOURLY = _struct(
    "vin string, event_hour timestamp, events bigint, avg_speed_mph double, "
    "max_speed_mph double, avg_battery_soc double, min_battery_soc double, "
    "max_battery_temp_c double, moving_events bigint, charging_events bigint, "
    "latest_odometer_miles double"
)
TRIPS = _struct(
    "vin string, event_date date, first_event_ts timestamp, last_event_ts timestamp, "
    "start_odometer_miles double, end_odometer_miles double, avg_speed_mph double, "
    "max_speed_mph double, autopilot_events bigint, distance_miles double"
)
BATTERY = _struct(
    "vin string, event_date date, avg_battery_soc double, min_battery_soc double, "
    "avg_battery_temp_c double, max_battery_temp_c double, charge_events bigint"
)
LEDGER = _struct("bucket_name string, object_key string, etag string, processed_at timestamp")
# --- end of fixed values ------------------------------------------------------
QUARANTINE = _struct(
    "bucket_name string, object_key string, etag string, problem_count bigint, "
    "first_problem string, quarantined_at timestamp"
)


@dataclass(frozen=True)
class TableSpec:
    """A curated table: row schema, upsert key and the column its folders are split by.

    ``day`` is an expression over the row; ``day_in_key`` says that equal keys always
    have equal days, so an upsert only has to look at the days of its source.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    day_column: str
    day: str
    day_in_key: bool
    required: tuple[str, ...]


TABLES = {
    t.name: t
    for t in (
        TableSpec("telemetry_enriched", ENRICHED, ("event_id",), "event_date", "event_date", False,
                  ("event_id", "vin", "event_ts", "ingest_ts", "event_type")),
        TableSpec("vehicle_hourly_metrics", HOURLY, ("vin", "event_hour"), "hour_date",
                  "to_date(event_hour)", True, ("vin", "event_hour")),
        TableSpec("trip_metrics", TRIPS, ("vin", "event_date"), "event_date", "event_date", True,
                  ("vin", "event_date")),
        TableSpec("battery_health", BATTERY, ("vin", "event_date"), "event_date", "event_date", True,
                  ("vin", "event_date")),
        TableSpec("alerts", ENRICHED, ("event_id",), "event_date", "event_date", False,
                  ("event_id", "vin", "event_ts", "ingest_ts", "event_type")),
    )
}

# What aggregates are kept as, to which later events can be added.
HOURLY_STATES = _struct(
    "vin string, event_hour timestamp, events bigint, speed_sum double, speed_count bigint, max_speed_mph double, "
    "soc_sum double, soc_count bigint, min_battery_soc double, max_battery_temp_c double, moving_events bigint, "
    "charging_events bigint, latest_odometer_miles double"
)
DAILY_STATES = _struct(
    "vin string, event_date date, moving_events bigint, first_event_ts timestamp, last_event_ts timestamp, "
    "start_odometer_miles double, end_odometer_miles double, speed_sum double, speed_count bigint, "
    "max_speed_mph double, autopilot_events bigint, soc_sum double, soc_count bigint, min_battery_soc double, "
    "temp_sum double, temp_count bigint, max_battery_temp_c double, charge_events bigint"
)
STATES = {
    t.name: t
    for t in (
        TableSpec("hourly_states", HOURLY_STATES, ("vin", "event_hour"), "hour_date", "to_date(event_hour)", True,
                  ("vin", "event_hour")),
        TableSpec("daily_states", DAILY_STATES, ("vin", "event_date"), "event_date", "event_date", True,
                  ("vin", "event_date")),
    )
}

# Where a line came from; sorts lines in listing order.
POSITION = ("object_key", "block_start", "row_id")
