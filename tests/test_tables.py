"""Curated tables: guards, untouched days, moving events."""

import datetime as dt

import pytest
from helpers import event, raw_events
from pyspark.sql import functions as F

from voltlog.operators import check, transform
from voltlog.schemas import TABLES
from voltlog.sources.jsonl import read_clean, write_json_lines
from voltlog.sources.tables import CuratedTable, KeyViolation

SPEC = TABLES["battery_health"]


def rows(spark, *values):
    data = [(vin, dt.date(2031, 2, day), soc, soc, 20.0, 30.0, 1) for vin, day, soc in values]
    return spark.createDataFrame(data, SPEC.schema)


def content(df):
    return sorted((r["vin"], r["event_date"].day, r["avg_battery_soc"]) for r in df.collect())


@pytest.fixture
def stage(spark, tmp_path):
    def write(name, df):
        path = str(tmp_path / "staging" / name)
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return write


def files(table):
    return {r[0] for r in table.read().select(F.input_file_name()).distinct().collect()}


def test_upsert_touches_only_the_days_it_must(spark, tmp_path, stage):
    table = CuratedTable.open(spark, str(tmp_path), SPEC)
    assert table.read().count() == 0
    table.upsert(rows(spark, ("a", 1, 1.0), ("b", 1, 2.0), ("a", 2, 3.0), ("z", 4, 9.0)), stage)
    assert content(table.read()) == [("a", 1, 1.0), ("a", 2, 3.0), ("b", 1, 2.0), ("z", 4, 9.0)]
    before = files(table)
    table.upsert(rows(spark, ("a", 2, 4.0), ("c", 1, 5.0), ("a", 3, 6.0)), stage)
    assert content(table.read()) == [
        ("a", 1, 1.0), ("a", 2, 4.0), ("a", 3, 6.0), ("b", 1, 2.0), ("c", 1, 5.0), ("z", 4, 9.0)]
    # Days 1 and 4 keep their files, day 2 was written anew.
    gone = before - files(table)
    assert len(gone) == 1 and "event_date=2031-02-02" in gone.pop()
    pruned = table.read().where("event_date = date'2031-02-03'")
    assert content(pruned) == [("a", 3, 6.0)]
    assert "PartitionFilters: [isnotnull(event_date" in pruned._jdf.queryExecution().toString()


def test_folders_are_bounded_by_days(spark, tmp_path, stage):
    table = CuratedTable.open(spark, str(tmp_path), SPEC)
    for i in range(6):
        table.upsert(rows(spark, ("a", 1, float(i)), ("b", 2, float(i)), (f"c{i}", 3, 1.0)), stage)
    folders = [p for p in (tmp_path / "curated" / SPEC.name).iterdir() if p.is_dir()]
    assert sorted(p.name for p in folders) == [f"event_date=2031-02-0{d}" for d in (1, 2, 3)]
    assert content(table.read())[:2] == [("a", 1, 5.0), ("b", 2, 5.0)]


def test_an_event_that_moves_leaves_its_old_day(spark, tmp_path, stage):
    table = CuratedTable.open(spark, str(tmp_path), TABLES["alerts"])
    clean, _ = check.check_records(raw_events(spark, [event(event_id="moving_1"), event(event_id="staying_1")]))
    table.upsert(stage("one", transform.enrich(clean)), stage)
    later = {"event_ts": "2031-02-13T08:00:00Z", "ingest_ts": "2031-02-13T08:00:01Z"}
    for ids in (["moving_1"], ["staying_1"]):
        clean, _ = check.check_records(raw_events(spark, [event(event_id=i, **later) for i in ids]))
        table.upsert(stage("two", transform.enrich(clean)), stage)
    assert sorted((r["event_id"], r["event_date"].day) for r in table.read().collect()) == [
        ("moving_1", 13), ("staying_1", 13)]


def test_stored_events_are_not_shuffled_for_a_batch(spark, tmp_path, stage):
    table = CuratedTable.open(spark, str(tmp_path), TABLES["telemetry_enriched"])
    clean, _ = check.check_records(raw_events(spark, [event(event_id=f"many_{i:06d}") for i in range(200)]))
    table.upsert(stage("one", transform.enrich(clean)), stage)
    batch = stage("two", table.read().limit(3))
    plan = table.replaced_rows(batch).select("event_date")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    schemas = [line for line in plan.split("ReadSchema: ")[1:]]
    assert all("latitude" not in s.split("\n")[0] for s in schemas)


def test_many_keys_are_not_sent_through_the_driver(spark, tmp_path, stage, monkeypatch):
    table = CuratedTable.open(spark, str(tmp_path), TABLES["telemetry_enriched"])
    clean, _ = check.check_records(raw_events(spark, [event(event_id=f"many_{i:06d}") for i in range(200)]))
    table.upsert(stage("one", transform.enrich(clean)), stage)
    batch = stage("two", table.read().limit(3))
    monkeypatch.setattr("voltlog.operators.merge.MOST_SENT", 2, raising=False)
    replaced = table.replaced_rows(batch)
    assert "Broadcast" not in replaced._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["event_id"] for r in replaced.collect()) == sorted(r["event_id"] for r in batch.collect())
    table.upsert(batch, stage)
    assert table.read().count() == 200


def test_guards(spark, tmp_path, stage):
    table = CuratedTable.open(spark, str(tmp_path), SPEC)
    with pytest.raises(KeyViolation, match="1 duplicate"):
        table.upsert(rows(spark, ("a", 1, 1.0), ("a", 1, 2.0)), stage)
    with pytest.raises(KeyViolation):
        table.upsert(rows(spark, (None, 1, 1.0)), stage)


def test_json_lines_keep_nulls_and_microseconds(spark, tmp_path):
    events = [event(event_ts="2031-02-11T08:00:00.000250+02:00"), event(event_id="evt_second")]
    clean, _ = check.check_records(raw_events(spark, events))
    folder = str(tmp_path / "clean")
    write_json_lines(clean, folder)
    write_json_lines(clean, folder)
    text = [r[0] for r in spark.read.text(folder).collect()]
    assert any('"event_ts":"2031-02-11T06:00:00.000250Z"' in line for line in text)
    assert all('"alert_code":null' in line for line in text)
    assert sorted(map(tuple, read_clean(spark, folder).collect())) == sorted(map(tuple, clean.collect()))
