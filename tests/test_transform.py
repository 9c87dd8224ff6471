"""The five tables of the seven-event sample, and the edges of the derived columns."""

import datetime as dt

import pytest
from helpers import VEHICLE_A, VEHICLE_B, event, raw_events, sample_batch

from voltlog.functions import derive
from voltlog.operators import check, transform
from voltlog.schemas import TABLES

T = lambda h, m=0: dt.datetime(2031, 2, 11, h, m)
DAY = dt.date(2031, 2, 11)


def tables_of(spark, events):
    clean, problems = check.check_records(raw_events(spark, events))
    assert problems.isEmpty()
    return transform.build_tables(clean)


def near(rows, expected):
    assert len(rows) == len(expected)
    for row, wanted in zip(rows, expected, strict=True):
        assert list(row) == [pytest.approx(v) if isinstance(v, float) else v for v in wanted]


def test_sample(spark):
    tables = tables_of(spark, sample_batch())
    assert set(tables) == set(TABLES)
    for name, df in tables.items():
        assert df.columns == list(TABLES[name].schema.names)
        assert [f.dataType for f in df.schema] == [f.dataType for f in TABLES[name].schema]
    enriched = tables["telemetry_enriched"].orderBy("event_id").collect()
    assert [r["battery_band"] for r in enriched] == ["normal", "critical", "low", "low", "high", "high", "high"]
    assert [r["is_moving"] for r in enriched] == [True, False, True, True, False, True, True]
    near(
        tables["vehicle_hourly_metrics"].orderBy("vin", "event_hour").collect(),
        [
            (VEHICLE_A, T(13), 2, 11.25, 22.5, 39.5, 15.0, 21.5, 1, 1, 512.0),
            (VEHICLE_A, T(14), 2, 58.5, 61.5, 46.0, 44.0, 26.5, 2, 0, 548.75),
            (VEHICLE_B, T(13), 1, 0.5, 0.5, 96.0, 96.0, 9.5, 0, 0, 77.25),
            (VEHICLE_B, T(15), 2, 15.0, 18.0, 88.5, 87.0, 12.5, 2, 0, 85.0),
        ],
    )
    near(
        tables["trip_metrics"].orderBy("vin").collect(),
        [
            (VEHICLE_A, DAY, T(13, 5), T(14, 50), 505.5, 548.75, 46.5, 61.5, 2, 43.25),
            (VEHICLE_B, DAY, T(15, 0), T(15, 30), 80.75, 85.0, 15.0, 18.0, 1, 4.25),
        ],
    )
    near(
        tables["battery_health"].orderBy("vin").collect(),
        [(VEHICLE_A, DAY, 42.75, 15.0, 22.5, 26.5, 1), (VEHICLE_B, DAY, 91.0, 87.0, 11.0, 12.5, 0)],
    )
    assert [r["event_id"] for r in tables["alerts"].collect()] == ["unit_000004"]


def test_derived_edges(spark):
    socs = [0, 15, 20, 20.01, 45, 50, 51, 80, 80.01, 95, 100]
    df = spark.createDataFrame([(float(x),) for x in socs], "soc double")
    bands = [r[0] for r in df.select(derive.battery_band(df.soc)).collect()]
    assert bands == ["critical"] * 3 + ["low"] * 3 + ["normal"] * 2 + ["high"] * 3
    events = [
        event(event_id="evt_speed_1", speed_mph=1.0, charging_state="CHARGING"),
        event(event_id="evt_speed_2", speed_mph=1.01, charging_state=" charging"),
        event(event_id="evt_zone_01", event_ts="2031-02-11T01:10:00.250+05:30"),
    ]
    rows = {r["event_id"]: r for r in tables_of(spark, events)["telemetry_enriched"].collect()}
    assert [rows[k]["is_moving"] for k in sorted(rows)] == [False, True, True]
    assert [rows[k]["is_charging"] for k in sorted(rows)] == [True, False, False]
    moved = rows["evt_zone_01"]
    assert moved["event_date"] == dt.date(2031, 2, 10)
    assert moved["event_hour"] == dt.datetime(2031, 2, 10, 19)
    assert moved["event_ts"] == dt.datetime(2031, 2, 10, 19, 40, 0, 250000)
