"""Accepted spellings, compared with the public validation library that defines them."""

import datetime as dt
import json
import math

import pytest
from helpers import event, raw_lines
from pyspark.sql import functions as F

from voltlog.operators import check

pydantic = pytest.importorskip("pydantic")

NUMBERS = [
    "34.2", " 34.2 ", "1e2", "1_0", "_10", "10_", "1__0", "1_0.5_0", "1._5", "+1.5", ".5", "5.", "-.5",
    "1e", "e5", "0x10", "1,5", "", "  ", "\t1\n", " 1", " 1", "١", "1 0", True, False, None,
    [1], {"a": 1}, "1E+1", "1e-5", "1e+_1", "+ 1", "--1", "1f", "1d", "1.0D", "+_1", "\x1c1", "1.e1", "0_1",
    "-_1", "1_e1", "1._", "._1", "nan", "n_an", "-nan", "inf", "Infinity", "-inf", "INF", 0, -0.0, 5, 5.25,
    12345678901234567890, 1e300, -1e300, " 1_0 ", 90, -90, 90.0001, -91, "1\n", "90\n",
]
FLAGS = [
    0, 1, 2, -1, 1.0, 0.0, 0.5, 2.0, 1e30, "yes", "Y", "on", "1", "true", "TRUE", " true ", "t", "T", "f",
    "n", "no", "off", "0", "OFF", "1.0", "", None, [], {}, True, False, 10**30, "oN", "yes\n", 2**63,
]
INSTANTS = [
    "2031-02-11T08:00:00Z", "2031-02-11t08:00:00z", "2031-02-11 08:00:00+05:30", "2031-02-11_08:00Z",
    "2031-02-11T08:00:00+0530", "2031-02-11T08:00:00+05", "2031-02-11T08:00:00.123456789Z",
    "2031-02-11T08:00:00.1234567891Z", "2031-02-11T08:00:00,5Z", "2031-02-11T08:00:00.Z",
    "2031-02-11T08:00:00 Z", "2031-02-11T08:00:00", "2031-02-11", "20310211T080000Z",
    "2031-02-11T08:00:60Z", "2031-02-11T24:00:00Z", "2031-02-30T08:00:00Z", "2031-13-01T08:00:00Z",
    "0000-01-01T00:00:00Z", "0001-01-01T00:00:00Z", "9999-12-31T23:59:59Z", "2031-02-11T08:00:00+18:01",
    "2031-02-11T08:00:00+23:59", "2031-02-11T08:00:00+24:00", "2031-02-11T08:00:00-00:00",
    "2031-02-11T08:00:00+05:60", 1717660800, 1717660800.5, -1, 0, True, "1717660800", "1717660800.25",
    "-5", " 5", "5 ", "+5", "1e9", ".5", "5.", 20000000000, 20000000001, -20000000001, "20000000001",
    1717660800123, "1717660800123.5", 1e18, 10**30, 253402300799999, 253402300800000, -62135596800000,
    -62135596800001, "inf", "nan", None, "", [], " 2031-02-11T08:00:00Z", "2031-02-11T08:00:00Z ",
    "2031-02-11T08:00:00Z\n", "2031-02-11T08Z", "2031-02-11T8:00:00Z", "2031-2-11T08:00:00Z",
    "2031-02-11T08:00:00−0530", "2031-02-11T08:00:00+05:30:00", "-1.5", "-0.5", "0", "-0", "00005",
    "2031-02-11T08:00:00.9999999Z", "2031-02-11T08:00.5Z", "2031-02-11T08:00+05:30", "2031-02-11T",
    "2024-02-29T00:00:00Z", "2023-02-29T00:00:00Z", "2031-02-11T08:60:00Z", "1_000", ".", "+",
    "12345678901234567890", "2031-02-11T08:00:00.25-03:15", "2031-02-30T08:00:00", "2031-02-11T25:00:00",
    "2031-02-11T08:00:00.1Z", "2031-02-11T23:59:59.999999+17:59", "2031-02-11T00:00:00-18:00",
]
TEXTS = ["abcdefg", "abcdefgh", "é" * 8, "\U0001f600" * 7, "\U0001f600" * 8, 5, True, None, [], {}, "", 12345678]
VINS = [
    "1HGTESTBED0000042", "1hgtestbed0000042", "  ABCDEFGHIJ", "ABCDEFGHIJ", "ABCDEFGHIJK", "AB CDEFGHIJK",
    "AB\tCDEFGHIJK", "\tABCDEFGHIJK\n", " ABCDEFGHIJ", "A" * 17, "A" * 18, " " * 12, 5, None, "\x1cABCDEFGHIJ",
    "straße1234567", "ABCDEFGHIJK\n",
]


class Vin(pydantic.BaseModel):
    value: str = pydantic.Field(min_length=11, max_length=17)


def field_type(kind, low=None, high=None):
    from typing import Annotated

    bounds = {}
    if low is not None:
        bounds["min_length" if kind is str else "ge"] = low
    if high is not None:
        bounds["max_length" if kind is str else "le"] = high
    return pydantic.TypeAdapter(Annotated[kind, pydantic.Field(**bounds)] if bounds else kind)


CASES = {
    "latitude": (field_type(float, -90, 90), NUMBERS),
    "odometer_miles": (field_type(float, 0), NUMBERS),
    "autopilot_engaged": (field_type(bool), FLAGS),
    "event_ts": (field_type(pydantic.AwareDatetime), INSTANTS),
    "ingest_ts": (field_type(pydantic.AwareDatetime), INSTANTS),
    "event_id": (field_type(str, 8), TEXTS),
    "gear": (field_type(str), TEXTS),
    "alert_code": (field_type(str | None), TEXTS),
}


def expected(adapter, value):
    try:
        typed = adapter.validate_python(value)
    except pydantic.ValidationError as error:
        return None, error.errors()[0]["msg"]
    if isinstance(typed, dt.datetime):
        utc = typed.replace(tzinfo=None) - typed.utcoffset()
        typed = (utc - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    return typed, None


ALL = [(name, value) for name, (_, values) in CASES.items() for value in values]
ALL += [("vin", value) for value in VINS]


def check_all(spark):
    lines = [json.dumps(event(**{name: value})) for name, value in ALL]
    checked = check.check_schema(raw_lines(spark, lines))
    for name in ("event_ts", "ingest_ts"):
        # Python cannot hold every year that occurs here.
        checked = checked.withColumn(name, F.unix_micros(name))
    return sorted(checked.collect(), key=lambda r: r["row_id"])


@pytest.fixture(scope="module")
def rows(spark):
    return check_all(spark)


@pytest.mark.parametrize("name", CASES)
def test_same_verdict_and_value(rows, name):
    adapter, _ = CASES[name]
    wrong = []
    for (field, value), row in zip(ALL, rows, strict=True):
        if field != name:
            continue
        typed, message = expected(adapter, value)
        if (row["error_text"] is None) != (message is None):
            wrong.append((value, message, row["error_text"]))
        elif message is None and row[name] != typed:
            wrong.append((value, typed, row[name]))
        elif message is not None:
            assert row["error_field"] == name
            # Why a time cannot be parsed is not told in the same words.
            if not message.startswith("Input should be a valid datetime") and row["error_text"] != message:
                wrong.append((value, message, row["error_text"]))
    assert wrong == []


def test_vin_is_cleaned(rows):
    for (field, value), row in zip(ALL, rows, strict=True):
        if field != "vin":
            continue
        try:
            typed = Vin(value=value).value.strip().upper()
            message = "Value error, VIN cannot contain spaces" if " " in typed else None
        except pydantic.ValidationError as error:
            typed, message = None, error.errors()[0]["msg"]
        assert row["error_text"] == message, value
        if message is None:
            assert row["vin"] == typed


def test_direct_reading_equals_careful_reading(spark, rows, monkeypatch):
    monkeypatch.setattr(check, "_is_plain", lambda: F.lit(False))
    careful = check_all(spark)

    def settled(row):
        return tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row)

    assert [settled(r) for r in rows] == [settled(r) for r in careful]
