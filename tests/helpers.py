"""Small event fixtures."""

import json

VEHICLE_A, VEHICLE_B = "1HGTESTBED0000042", "WAUTESTBED0000977"
DAY = "2031-02-11"


def event(**changes) -> dict:
    base = {
        "event_id": "unit_base_77",
        "vin": VEHICLE_A,
        "event_ts": f"{DAY}T08:00:00Z",
        "ingest_ts": f"{DAY}T08:00:03Z",
        "event_type": "telemetry",
        "latitude": 41.5,
        "longitude": 12.75,
        "speed_mph": 24.25,
        "battery_soc": 61.5,
        "battery_temp_c": 17.75,
        "odometer_miles": 505.25,
        "charging_state": "Idle",
        "gear": "N",
        "autopilot_engaged": False,
        "alert_code": None,
        "software_version": "r7.0.1",
    }
    return {**base, **changes}


def sample_batch() -> list[dict]:
    """Seven events of two vehicles whose results are worked out by hand in ``test_transform``."""

    def of(no, vin, clock, **measured):
        return event(
            event_id=f"unit_{no:06d}", vin=vin, event_ts=f"{DAY}T{clock}:00Z", ingest_ts=f"{DAY}T{clock}:05Z", **measured
        )

    return [
        of(1, VEHICLE_A, "13:05", speed_mph=22.5, battery_soc=64.0, battery_temp_c=18.0, odometer_miles=505.5,
           autopilot_engaged=True),
        of(2, VEHICLE_A, "13:40", event_type="charge", speed_mph=0.0, battery_soc=15.0, battery_temp_c=21.5,
           odometer_miles=512.0, charging_state="Charging"),
        of(3, VEHICLE_A, "14:10", speed_mph=55.5, battery_soc=48.0, battery_temp_c=24.0, odometer_miles=530.25),
        of(4, VEHICLE_A, "14:50", event_type="alert", alert_code="CABIN_DOOR_AJAR", speed_mph=61.5, battery_soc=44.0,
           battery_temp_c=26.5, odometer_miles=548.75, autopilot_engaged=True),
        of(5, VEHICLE_B, "13:15", speed_mph=0.5, battery_soc=96.0, battery_temp_c=9.5, odometer_miles=77.25),
        of(6, VEHICLE_B, "15:00", speed_mph=12.0, battery_soc=90.0, battery_temp_c=11.0, odometer_miles=80.75,
           autopilot_engaged=True),
        of(7, VEHICLE_B, "15:30", speed_mph=18.0, battery_soc=87.0, battery_temp_c=12.5, odometer_miles=85.0),
    ]


def without(record: dict, *keys: str) -> dict:
    return {k: v for k, v in record.items() if k not in keys}


def raw_lines(spark, lines, object_key="telemetry/events.jsonl"):
    rows = [(object_key, 0, i, line) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "object_key string, block_start long, row_id long, value string")


def raw_events(spark, events, **kwargs):
    return raw_lines(spark, [json.dumps(e) for e in events], **kwargs)
