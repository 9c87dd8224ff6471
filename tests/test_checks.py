"""Checks of a batch: the known cases, strict JSON, reporting order, hot duplicates."""

import json

from helpers import event, raw_events, raw_lines, without
from pyspark.sql import functions as F

from voltlog.operators import check
from voltlog.operators.lines import drop_blank, number_lines
from voltlog.schemas import POSITION


def sentences(spark, events):
    clean, problems = check.check_records(raw_events(spark, events))
    ordered = problems.orderBy(*POSITION, "rule_no").collect()
    return clean.count(), [r["problem"] for r in ordered]


def test_many_events_in_one_batch(spark):
    events = [
        event(),
        event(event_id="evt_high_soc", battery_soc=120),
        event(),
        event(event_id="evt_no_code", event_type="alert"),
        event(event_id="evt_empty_code", event_type="alert", alert_code=""),
        event(event_id="evt_naive", event_ts="2031-02-11T08:00:00"),
        event(event_id="evt_two_wrong", gear=5, latitude=100),
        event(event_id="evt_extra", note=1, another=2),
        without(event(event_id="evt_no_gear"), "gear"),
        without(event(event_id="evt_no_code_key"), "alert_code"),
        without(event(), "event_id"),
        event(event_id=None),
        event(event_id=True),
        event(event_id=7),
        event(event_id="evt_same_time", ingest_ts="2031-02-11T08:00:00Z"),
        event(event_id="evt_late", ingest_ts="2031-02-11T07:59:59Z", odometer_miles=0),
        event(event_id="evt_parked", speed_mph=0, odometer_miles=0),
        event(event_id="evt_creeping", speed_mph=0.5, odometer_miles=0),
        event(),
        event(event_id="evt_zones", event_ts="2031-02-11T13:30:00+05:30"),
        event(event_id="evt_wrong_and_twice", speed_mph=-1),
        event(event_id="evt_wrong_and_twice"),
        event(event_id="evt_all_rules", event_type="alert", event_ts="2031-02-11T09:00:00Z", odometer_miles=0),
    ]
    clean, problems = sentences(spark, events)
    assert clean == len(events) - 10
    assert problems == [
        "evt_high_soc: field 'battery_soc' is wrong: Input should be less than or equal to 100",
        "unit_base_77: duplicate event_id in this batch",
        "evt_no_code: alert event has no alert_code",
        "evt_empty_code: alert event has no alert_code",
        "evt_naive: field 'event_ts' is wrong: Input should have timezone info",
        "evt_two_wrong: field 'latitude' is wrong: Input should be less than or equal to 90",
        "evt_extra: field 'note' is wrong: Extra inputs are not permitted",
        "evt_no_gear: field 'gear' is wrong: Field required",
        "unknown: field 'event_id' is wrong: Field required",
        "None: field 'event_id' is wrong: Input should be a valid string",
        "True: field 'event_id' is wrong: Input should be a valid string",
        "7: field 'event_id' is wrong: Input should be a valid string",
        "evt_late: event_ts is later than ingest_ts",
        "evt_late: speed is above 0 but odometer is 0",
        "evt_creeping: speed is above 0 but odometer is 0",
        "unit_base_77: duplicate event_id in this batch",
        "evt_wrong_and_twice: field 'speed_mph' is wrong: Input should be greater than or equal to 0",
        "evt_all_rules: event_ts is later than ingest_ts",
        "evt_all_rules: speed is above 0 but odometer is 0",
        "evt_all_rules: alert event has no alert_code",
    ]


GOOD = json.dumps(event())
STRICT = {
    GOOD: False,
    "  " + GOOD + "\t ": False,
    json.dumps(event(), separators=(",", ":")): False,
    json.dumps(event(), indent=0).replace("\n", " "): False,
    json.dumps(dict(reversed(event().items()))): False,
    json.dumps(event(gear="dé\U0001f600"), ensure_ascii=False): False,
    json.dumps(event(gear='a "quoted" \\ text')): False,
    GOOD[:-1] + ', "gear": "P"}': False,
    GOOD + " trailing": True,
    GOOD + "]": True,
    GOOD + "}": True,
    GOOD + GOOD: True,
    GOOD + "," + GOOD: True,
    GOOD + "],[" + GOOD: True,
    GOOD + "//comment": True,
    GOOD[:-1]: True,
    GOOD[:-1] + ",}": True,
    GOOD.replace('"', "'"): True,
    GOOD.replace("41.5", "041.5"): True,
    GOOD.replace("41.5", "NaN"): True,
    GOOD.replace('"N"', '"\t"'): True,
    " " + GOOD: True,
    "﻿" + GOOD: True,
    "5": True,
    "null": True,
    '"text"': True,
    f"[{GOOD}]": True,
    "{}": False,
}


def test_strict_json(spark):
    checked = check.check_schema(raw_lines(spark, list(STRICT)))
    got = {r["row_id"]: r["broken"] for r in checked.collect()}
    assert [got[i] for i in range(len(STRICT))] == list(STRICT.values())


def test_invalid_utf8_is_broken(spark):
    raw = raw_lines(spark, [GOOD]).withColumn(
        "value", F.concat(F.lit(GOOD[:-2]).cast("binary"), F.unhex(F.lit("ff"))).cast("string")
    ).withColumn("value", F.concat("value", F.lit('"}')))
    assert check.check_schema(raw).first()["broken"]


def test_last_of_repeated_keys_counts(spark):
    lines = [GOOD[:-1] + ', "gear": "P"}', GOOD[:-1] + ', "gear": 5}', GOOD[:-1] + ', "latitude": 100}']
    rows = sorted(check.check_schema(raw_lines(spark, lines)).collect(), key=lambda r: r["row_id"])
    assert rows[0]["gear"] == "P"
    assert [r["error_field"] for r in rows] == [None, "gear", "latitude"]


def test_halves_of_surrogate_pairs_are_no_text(spark):
    plain = event(event_id="unit_half_1")
    lines = [
        json.dumps(plain | {"gear": "\ud83d\ude00"}),
        json.dumps(plain | {"gear": "x\ud800"}),
        json.dumps(plain | {"gear": "\udc00y", "latitude": 100}),
        json.dumps(plain | {"gear": "\ud83d\ude00\ude00"}),
        json.dumps(plain).replace('"N"', r'"\\ud800"'),
    ]
    rows = sorted(check.check_schema(raw_lines(spark, lines)).collect(), key=lambda r: r["row_id"])
    assert [r["error_field"] for r in rows] == [None, "gear", "latitude", "gear", None]
    assert rows[0]["gear"] == "\U0001f600" and rows[4]["gear"] == r"\ud800"
    assert rows[1]["error_text"].startswith("Input should be a valid string, unable")


def test_blank_lines(spark):
    lines = ["", "  ", "\t", "  ", "\x1c", "x", " {", GOOD]
    kept = drop_blank(raw_lines(spark, lines)).select("row_id").collect()
    assert sorted(r[0] for r in kept) == [5, 6, 7]


def test_line_numbers_across_blocks(spark):
    rows = [("a", 0, 10, "1"), ("a", 0, 11, "2"), ("a", 64, 5, "3"), ("a", 128, 0, "4"), ("b", 0, 7, "1"),
            ("b", 64, 100, "2"), ("b", 64, 101, "3")]
    raw = spark.createDataFrame(rows, "object_key string, block_start long, row_id long, value string")
    numbered = number_lines(raw).collect()
    assert len(numbered) == len(rows)
    assert all(str(r["line_no"]) == r["value"] for r in numbered)


def test_duplicates_with_hot_ids(spark):
    n = 12_000
    # A third of the rows share one id, another third 2,000 ids, some others come in pairs.
    ids = ["hot" if i % 3 == 0 else f"warm{i % 2000}" if i % 3 == 1 else f"pair{i // 5}" if i % 5 < 2 else f"id{i}"
           for i in range(n)]
    rows = [(f"file{i % 7}", i % 4 * 64, i, ids[i]) for i in range(n)]
    df = spark.createDataFrame(rows, "object_key string, block_start long, row_id long, event_id string")
    got = {(r[0], r[1], r[2]) for r in check.later_duplicates(df).select(*POSITION).collect()}
    seen, expected = set(), set()
    for key, block, row, name in sorted(rows):
        if name in seen:
            expected.add((key, block, row))
        seen.add(name)
    assert got == expected


def test_very_long_line(spark):
    members = ",".join(f'"speed_mph": {i % 90}' for i in range(50_000))
    lines = [GOOD[:-1] + "," + members + "}", GOOD[:-1] + "," + members + ', "note": 1}']
    rows = sorted(check.check_schema(raw_lines(spark, lines)).collect(), key=lambda r: r["row_id"])
    assert [r["error_field"] for r in rows] == [None, "note"]
    assert rows[0]["speed_mph"] == float(49_999 % 90)
