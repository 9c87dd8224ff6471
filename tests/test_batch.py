"""Whole runs over folders of JSON-lines files."""

import datetime as dt
import hashlib
import io
import json
import os
from pathlib import Path

import pytest
from helpers import DAY, VEHICLE_A, event, sample_batch
from pyspark.sql import functions as F

from voltlog.operators import reports, transform
from voltlog.operators.lines import number_lines
from voltlog.plans import adapter
from voltlog.plans.batch import BatchRejected, Warehouse, run_batch
from voltlog.sources import files, hadoop
from voltlog.sources.files import Source, candidate_report, list_files, new_files, read_lines, split_lines, with_etags
from voltlog.sources.listing import walk
from voltlog.sources.stores import LocalStore, NoStore, S3Store, store_of
from voltlog.sources.tables import CuratedTable


class Site:
    """A source tree and a warehouse below one folder."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.source = Source(str(folder / "bucket"))
        self.house = Warehouse(spark, str(folder / "warehouse"))

    def put(self, key, events, newline="\n"):
        path = self.folder / "bucket" / "telemetry" / key
        path.parent.mkdir(parents=True, exist_ok=True)
        lines = [e if isinstance(e, str) else json.dumps(e) for e in events]
        path.write_bytes("".join(line + newline for line in lines).encode())

    def run(self, **options):
        return run_batch(self.spark, self.source, self.house.path, **options)

    def counts(self):
        rows = reports.row_counts(self.house.tables()).collect()
        return [r["row_count"] for r in rows]

    def ledger_size(self):
        return self.house.ledger.read().count()

    def rows(self, table, order):
        return [r.asDict() for r in self.house.table(table).read().orderBy(*order).collect()]


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


SAMPLE_KEY = "year=2031/month=02/day=11/hour=13/events.jsonl"


def test_sample_rerun_same_events_and_changed_content(site, spark):
    assert site.run().status == "skipped"
    with pytest.raises(FileNotFoundError):
        candidate_report(spark, site.source)
    site.put(SAMPLE_KEY, sample_batch())
    site.put("year=2031/notes.JSONL", ["not a candidate"])
    site.put("readme.txt", ["not a candidate"])
    site.put("year=2031/month=02/empty.jsonl", [])
    result = site.run()
    assert (result.status, result.files, result.events) == ("loaded", 2, 7)
    assert site.counts() == [7, 4, 2, 2, 1]
    loaded = reports.loaded_files(site.house.ledger.read()).collect()
    assert [r["object_key"] for r in loaded] == [
        "telemetry/" + SAMPLE_KEY, "telemetry/year=2031/month=02/empty.jsonl"]
    before = site.rows("telemetry_enriched", ["event_id"])
    # Nothing new.
    assert site.run().status == "skipped"
    assert (site.counts(), site.ledger_size()) == ([7, 4, 2, 2, 1], 2)
    # The same events in a file of another name change nothing but the ledger.
    site.put("hour=09/a+b c%41[1].jsonl", sample_batch(), newline="\r\n")
    assert site.run().files == 1
    assert site.rows("telemetry_enriched", ["event_id"]) == before
    assert (site.counts(), site.ledger_size()) == ([7, 4, 2, 2, 1], 3)
    assert site.run().status == "skipped"
    # Changed content is loaded again: an alert becomes telemetry and moves to the next day.
    changed = sample_batch()
    changed[3] |= {"event_type": "telemetry", "event_ts": "2031-02-12T14:50:00Z",
                   "ingest_ts": "2031-02-12T14:50:05Z"}
    site.put(SAMPLE_KEY, changed)
    assert site.run().files == 1
    # Rows are never deleted: the old alert and the hour and day figures stay or are replaced.
    assert site.counts() == [7, 5, 3, 3, 1]
    moved = [r for r in site.rows("telemetry_enriched", ["event_id"]) if r["event_id"] == "unit_000004"]
    assert [r["event_date"] for r in moved] == [dt.date(2031, 2, 12)]
    hours = site.rows("vehicle_hourly_metrics", ["vin", "event_hour"])
    assert [h["events"] for h in hours[:3]] == [2, 1, 1]
    # Content that goes back to what was loaded once is not loaded again.
    site.put(SAMPLE_KEY, sample_batch())
    assert site.run().status == "skipped"


def problems(site):
    return [r["problem"] for r in site.house.staged("problems").orderBy("object_key", "row_id", "rule_no").collect()]


def test_two_copies_in_one_run_are_rejected_and_retried(site):
    site.put(SAMPLE_KEY, sample_batch())
    site.put("hour=09/events.jsonl", sample_batch())
    with pytest.raises(BatchRejected, match="7 x duplicate event_id in this batch") as error:
        site.run()
    assert "/staging/problems" in str(error.value) and len(problems(site)) == 7
    assert (site.counts(), site.ledger_size()) == ([0] * 5, 0)
    # Loading one file is an option; the one with the second copies waits for the next run.
    result = site.run(quarantine_bad_files=True)
    assert (result.files, result.quarantined, result.postponed, result.events) == (1, 0, 1, 7)
    assert [r["object_key"] for r in site.house.ledger.read().collect()] == ["telemetry/hour=09/events.jsonl"]
    assert site.counts() == [7, 4, 2, 2, 1]
    result = site.run(quarantine_bad_files=True)
    assert (result.files, result.postponed) == (1, 0)
    assert (site.counts(), site.ledger_size()) == ([7, 4, 2, 2, 1], 2)
    assert site.run().status == "skipped"


def test_a_good_file_is_not_set_aside_for_an_id_of_a_bad_one(site):
    shared = event(event_id="shared_1")
    site.put("a.jsonl", [shared, event(event_id="bad_row_1", battery_soc=101)])
    site.put("b.jsonl", [shared, event(event_id="good_row_1")])
    site.put("c.jsonl", [event(event_id="twice_01"), event(event_id="twice_01")])
    result = site.run(quarantine_bad_files=True)
    assert (result.files, result.quarantined, result.postponed, result.events) == (1, 2, 0, 2)
    aside = {r["object_key"]: r["first_problem"] for r in site.house.quarantine.read().collect()}
    assert aside == {
        "telemetry/a.jsonl": "bad_row_1: field 'battery_soc' is wrong: Input should be less than or equal to 100",
        "telemetry/c.jsonl": "twice_01: duplicate event_id in this batch",
    }
    assert {r["event_id"] for r in site.rows("telemetry_enriched", ["event_id"])} == {"shared_1", "good_row_1"}


def test_a_change_of_content_alone_is_loaded(site):
    site.put("1.jsonl", [event(event_id="corrected", battery_soc=41.5)])
    path = site.folder / "bucket" / "telemetry" / "1.jsonl"
    site.run()
    stat = os.stat(path)
    site.put("1.jsonl", [event(event_id="corrected", battery_soc=41.9)])
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert os.stat(path).st_size == stat.st_size
    assert site.run().files == 1
    assert site.rows("telemetry_enriched", ["event_id"])[0]["battery_soc"] == 41.9


@pytest.mark.parametrize("count", [2, 3000])
def test_other_line_breaks_are_other_content_at_every_size(site, spark, count):
    def etag():
        found = site.house.stage("candidates", list_files(spark, site.source))
        return with_etags(spark, site.source, found).first()["etag"]

    lines = [event(event_id=f"unit_{i:06d}") for i in range(count)]
    site.put("1.jsonl", lines)
    unix = etag()
    site.put("1.jsonl", lines, newline="\r\n")
    assert etag() != unix
    text = "".join(json.dumps(x) + ("\r\n" if i == 0 else "\n") for i, x in enumerate(lines)).encode()
    other = "".join(json.dumps(x) + ("\r\n" if i == 1 else "\n") for i, x in enumerate(lines)).encode()
    path = site.folder / "bucket" / "telemetry" / "1.jsonl"
    path.write_bytes(text)
    first = etag()
    path.write_bytes(other)
    assert len(text) == len(other) and etag() != first


def test_hidden_names_are_files_like_others(site):
    site.put("day=1/good.jsonl", sample_batch())
    hidden = ["_part.jsonl", ".hidden/x.jsonl", "a/_b/c/y z%41.jsonl", "day=1/.z.jsonl"]
    for i, key in enumerate(hidden):
        site.put(key, [event(event_id=f"hidden_event_{i}"), "", event(event_id=f"hidden_second_{i}")], newline="\r\n")
    site.put("day=1/_SUCCESS", [])
    site.put("_empty.jsonl", [])
    result = site.run()
    assert (result.files, result.events) == (6, 15)
    keys = {r["object_key"] for r in site.house.ledger.read().collect()}
    assert keys == {f"telemetry/{k}" for k in ["day=1/good.jsonl", "_empty.jsonl", *hidden]}
    assert site.run().status == "skipped"
    site.put("_part.jsonl", [event(event_id="hidden_event_9"), "{"])
    with pytest.raises(BatchRejected, match="telemetry/_part.jsonl line 2 is not a valid JSON object"):
        site.run()


@pytest.mark.parametrize("size", [1, 2, 3, 5, 100])
def test_lines_end_as_in_sparks_reader(spark, tmp_path, size):
    text = b"\xef\xbb\xbfa\r\n\r\nb\rc\n\n\xff\xfe d\r\r\n e \n\rlast"
    for ending in (b"", b"\n", b"\r\n", b"\r"):
        whole = text + ending
        (tmp_path / "x.txt").write_bytes(whole)
        read = spark.read.text(str(tmp_path / "x.txt")).selectExpr("cast(value AS binary) AS value").collect()
        chunks = [whole[i : i + size] for i in range(0, len(whole), size)]
        assert list(split_lines(chunks)) == [bytes(r["value"]) for r in read]
    assert list(split_lines([])) == []


def files_in_plan(lines):
    """Names of the files that a scan has in its index."""
    return {f.rsplit("/", 1)[-1] for f in lines.inputFiles()}


def test_one_new_file_among_a_thousand_is_the_only_one_read(site, spark):
    spark.sparkContext.addPyFile(str(Path(__file__).with_name("etag_stores.py")))
    site.source = Source(site.source.root, store="etag_stores:EtagStore")
    for i in range(1000):
        site.put(f"{i:04d}.jsonl", [event(event_id=f"unit_{i:06d}")])
    assert site.run().files == 1000
    site.put("flat_new.jsonl", [event(event_id="unit_new_1"), "", event(event_id="unit_new_2")])
    seen = site.house.ledger.read().select("object_key", "etag")
    found = list_files(spark, site.source)
    new = site.house.stage("new", new_files(found, seen))
    assert [r["object_key"] for r in new.collect()] == ["telemetry/flat_new.jsonl"]
    lines = read_lines(spark, site.source, new)
    assert files_in_plan(lines) == {"flat_new.jsonl"}
    numbered = number_lines(lines).orderBy("line_no").collect()
    assert [(r["line_no"], bool(r["value"])) for r in numbered] == [(1, True), (2, False), (3, True)]
    result = site.run()
    assert (result.files, result.events) == (1, 2)
    # the store's own etags are in the ledger, and nothing was read for them
    assert {len(r["etag"]) for r in site.house.ledger.read().collect()} == {40}
    assert site.run().status == "skipped"


def test_etags_only_for_files_without_one(site, spark):
    site.put("a.jsonl", [event(event_id="unit_etag_a")])
    site.put("b.jsonl", [event(event_id="unit_etag_b")])
    site.put("empty.jsonl", [])
    found = list_files(spark, site.source)
    known = F.when(F.col("object_key").endswith("a.jsonl"), F.lit("from the store"))
    listed = site.house.stage("candidates", found.withColumn("etag", known))
    etags = {r["object_key"][10:]: r["etag"] for r in with_etags(spark, site.source, listed).collect()}
    content = (site.folder / "bucket" / "telemetry" / "b.jsonl").read_bytes()
    own = hashlib.md5(hashlib.md5(content).hexdigest().encode()).hexdigest() + "-1"
    assert etags == {"a.jsonl": "from the store", "b.jsonl": own, "empty.jsonl": hashlib.md5().hexdigest() + "-0"}


def test_large_files_are_hashed_in_parts(site, spark, monkeypatch):
    monkeypatch.setattr(files, "PART", 1000)
    lines = [event(event_id=f"unit_{i:06d}") for i in range(40)]
    site.put("1.jsonl", lines)
    found = site.house.stage("candidates", list_files(spark, site.source))
    first = with_etags(spark, site.source, found).first()["etag"]
    content = (site.folder / "bucket" / "telemetry" / "1.jsonl").read_bytes()
    parts = [content[i : i + 1000] for i in range(0, len(content), 1000)]
    whole = "".join(hashlib.md5(p).hexdigest() for p in parts)
    assert first == f"{hashlib.md5(whole.encode()).hexdigest()}-{len(parts)}"
    lines[3], lines[30] = lines[30], lines[3]
    site.put("1.jsonl", lines)
    assert with_etags(spark, site.source, found).first()["etag"] != first


def test_folders_are_listed_by_several_tasks(spark, tmp_path):
    keys = {f"p{i % 9}/q={i % 5}/{'_' * (i % 2)}f{i}.jsonl" for i in range(200)} | {"top.jsonl", "p1/flat.jsonl", "p2/.x/y.jsonl"}
    for key in keys:
        path = tmp_path / "telemetry" / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x" * (len(key) % 4))
    (tmp_path / "telemetry/p3/other.txt").write_text("no candidate")
    listed = list_files(spark, Source(str(tmp_path)))
    assert {r["object_key"] for r in listed.collect()} == {f"telemetry/{k}" for k in keys}
    assert {r["object_key"]: r["length"] for r in listed.collect()} == {f"telemetry/{k}": len(k) % 4 for k in keys}
    assert listed.rdd.getNumPartitions() > 20
    assert list_files(spark, Source(str(tmp_path), prefix="nowhere/")).collect() == []


class FakeBucket:
    """As much of an object store's client as the store uses."""

    def __init__(self, objects):
        self.objects = objects

    def get_paginator(self, _):
        return self

    def paginate(self, Bucket, Prefix, Delimiter):
        below = [k for k in self.objects if k.startswith(Prefix)]
        subs = sorted({Prefix + k[len(Prefix):].split("/")[0] + "/" for k in below if "/" in k[len(Prefix):]})
        when = dt.datetime(2031, 2, 11, tzinfo=dt.timezone.utc)
        own = [k for k in below if "/" not in k[len(Prefix):]]
        yield {"CommonPrefixes": [{"Prefix": s} for s in subs]}
        yield {"Contents": [
            {"Key": k, "Size": len(self.objects[k]), "ETag": f'"etag of {k}"', "LastModified": when} for k in own]}

    def get_object(self, Bucket, Key, Range):
        start, end = (int(n) for n in Range.removeprefix("bytes=").split("-"))
        return {"Body": io.BytesIO(self.objects[Key][start : end + 1])}


def test_an_object_store_tells_its_etags():
    store = S3Store(FakeBucket({"t/": b"", "t/a.jsonl": b"abc", "t/_b/c.jsonl": b"defgh", "u/x": b""}))
    got = sorted(walk(store, "s3a://bucket/t"), key=lambda e: e.path)
    assert [(e.path, e.length, e.etag) for e in got] == [
        ("s3a://bucket/t/_b/c.jsonl", 5, "etag of t/_b/c.jsonl"), ("s3a://bucket/t/a.jsonl", 3, "etag of t/a.jsonl")]
    assert store.read("s3a://bucket/t/_b/c.jsonl", 1, 3) == b"efg"


def test_the_store_of_a_path():
    assert isinstance(store_of("file:/x/y"), LocalStore) and isinstance(store_of("/x"), LocalStore)
    with pytest.raises(NoStore, match="cannot list nosuch://x/y"):
        store_of("nosuch://x/y")


def test_bad_value_broken_line_and_empty_batch(site):
    site.put("a/empty.jsonl", ["", "  "])
    with pytest.raises(BatchRejected, match="no events"):
        site.run()
    site.put("b/good.jsonl", sample_batch())
    site.put("c/bad.jsonl", [event(battery_soc=150)])
    with pytest.raises(BatchRejected, match="1 x field 'battery_soc' is wrong"):
        site.run()
    site.put("d/broken.jsonl", [event(event_id="evt_after_1"), "", "\t", '{"a": 1} x', "{"])
    with pytest.raises(BatchRejected, match="telemetry/d/broken.jsonl line 4 is not a valid JSON object"):
        site.run()
    assert (site.counts(), site.ledger_size()) == ([0] * 5, 0)
    result = site.run(quarantine_bad_files=True)
    assert (result.files, result.quarantined, result.events) == (2, 2, 7)
    assert site.counts() == [7, 4, 2, 2, 1]
    site.put("c/bad.jsonl", [event(battery_soc=50)])
    assert site.run().events == 1
    assert site.counts()[0] == 8


def later_events():
    """One more event in an hour that is loaded, and one loaded event moved to another day."""
    moved = sample_batch()[6] | {"event_ts": "2031-02-13T10:00:00Z", "ingest_ts": "2031-02-13T10:00:01Z"}
    return [
        event(event_id="unit_000008", event_ts="2031-02-11T13:50:00Z", ingest_ts="2031-02-11T13:50:02Z",
              speed_mph=50.0, battery_soc=60.0, battery_temp_c=33.0, odometer_miles=515.0),
        moved,
    ]


def hours_of(site):
    hours = site.rows("vehicle_hourly_metrics", ["vin", "event_hour"])
    return [(r["vin"] == VEHICLE_A, r["event_hour"].hour, r["events"]) for r in hours]


def test_later_batch_replaces_aggregates(site):
    site.put("1.jsonl", sample_batch())
    site.run()
    site.put("2.jsonl", later_events())
    site.run()
    assert hours_of(site) == [(True, 13, 1), (True, 14, 2), (False, 13, 1), (False, 15, 2), (False, 10, 1)]


def test_recompute(site, monkeypatch):
    site.put("1.jsonl", sample_batch())
    site.run(recompute_aggregates=True)
    site.put("2.jsonl", later_events())
    # The first try dies after the events were changed; the second one must still find the old hour.
    monkeypatch.setattr(transform, "hourly_of", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        site.run(recompute_aggregates=True)
    monkeypatch.undo()
    assert site.run(recompute_aggregates=True).files == 1
    assert hours_of(site) == [(True, 13, 3), (True, 14, 2), (False, 13, 1), (False, 15, 1), (False, 10, 1)]
    days = site.rows("trip_metrics", ["vin", "event_date"])
    assert [(r["event_date"].day, r["end_odometer_miles"]) for r in days] == [(11, 548.75), (11, 80.75), (13, 85.0)]
    assert site.counts()[0] == 8


def test_rows_are_counted_from_footers(site, spark):
    site.put("1.jsonl", sample_batch())
    site.run()
    counts = site.house.row_counts()
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 5
    assert [r["row_count"] for r in counts.collect()] == [7, 4, 2, 2, 1]
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def all_metrics(site):
    """The aggregates as stored, and as all stored events give them."""
    enriched = site.house.table("telemetry_enriched").read()
    fresh = {
        "vehicle_hourly_metrics": transform.hourly_metrics(enriched), "trip_metrics": transform.trip_metrics(enriched),
        "battery_health": transform.battery_health(enriched),
    }
    rounded = lambda rows: sorted(
        tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows.collect())
    return [rounded(site.house.table(n).read()) for n in fresh], [rounded(f) for f in fresh.values()]


def test_added_events_are_merged_without_reading_old_ones(site, spark, monkeypatch):
    site.put("1.jsonl", sample_batch())
    site.run(recompute_aggregates=True)
    added = [event(event_id="unit_added_1", event_ts=f"{DAY}T13:59:00Z", ingest_ts=f"{DAY}T13:59:01Z", speed_mph=80.0,
                   battery_soc=10.0, odometer_miles=600.0, autopilot_engaged=True)]
    site.put("2.jsonl", added)
    read = []
    stored = CuratedTable._of_days

    def seen(table, days):
        read.append((table.spec.name, sorted(map(str, days))))
        return stored(table, days)

    monkeypatch.setattr(CuratedTable, "_of_days", seen)
    assert site.run(recompute_aggregates=True).events == 1
    assert [days for name, days in read if name in ("telemetry_enriched", "alerts")] and all(
        days == [] for name, days in read if name in ("telemetry_enriched", "alerts"))
    monkeypatch.undo()
    kept, fresh = all_metrics(site)
    assert kept == fresh
    assert hours_of(site)[0] == (True, 13, 3)


def test_states_stay_right_over_mixed_runs_and_crashes(site, monkeypatch):
    site.put("1.jsonl", sample_batch())
    site.run()  # no states yet
    site.put("2.jsonl", [event(event_id="unit_second_1", event_ts=f"{DAY}T13:20:00Z", ingest_ts=f"{DAY}T13:20:01Z")])
    site.run(recompute_aggregates=True)
    kept, fresh = all_metrics(site)
    assert kept == fresh
    site.put("3.jsonl", [event(event_id="unit_third_1", event_ts=f"{DAY}T13:25:00Z", ingest_ts=f"{DAY}T13:25:01Z")])
    site.run()  # goes past the states, and replaces the hour by its own events
    site.put("4.jsonl", [event(event_id="unit_fourth_1", event_ts=f"{DAY}T13:30:00Z", ingest_ts=f"{DAY}T13:30:01Z")])
    table = type(site.house.ledger)
    append = table.append
    monkeypatch.setattr(table, "append", lambda t, rows: append(t, rows) if "processed" not in t.path else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        site.run(recompute_aggregates=True)
    monkeypatch.undo()
    kept, fresh = all_metrics(site)
    assert kept == fresh
    assert site.run(recompute_aggregates=True).events == 1  # the same events once more, not counted twice
    kept, fresh = all_metrics(site)
    assert kept == fresh and site.counts()[0] == 10


def test_replaced_events_are_looked_for_in_few_folders(site, spark):
    """Thirty days of events and a batch of ten ids: the bytes opened go with the batch."""
    base = dt.datetime(2031, 3, 1, 8)
    for part in range(3):
        site.put(f"{part}.jsonl", [
            event(event_id=f"history_{d:02d}_{i:04d}", event_ts=f"{base + dt.timedelta(days=d, seconds=i):%Y-%m-%dT%H:%M:%S}Z",
                  ingest_ts="2031-05-01T00:00:00Z") for d in range(part * 10, part * 10 + 10) for i in range(200)])
    site.run()
    events = site.house.table("telemetry_enriched")
    batch = site.house.stage("batch", events.read().where("event_id like 'history_03_000%'").withColumn(
        "event_date", F.lit("2031-06-01").cast("date")))
    everything = site.house.stage("everything", events.read())
    size = lambda df: sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in df.inputFiles())
    assert batch.count() == 10
    few, many = events.index.entries_of(batch), events.index.entries_of(everything)
    assert 0 < size(few) < 0.25 * size(many)
    found = events.replaced_rows(batch)
    assert {str(r["event_date"]) for r in found.collect()} == {"2031-03-04"} and found.count() == 10
    assert all("event_date=2031-03-04" in f for f in found.inputFiles() if "/curated/" in f)
    # a moved event is found at its new day, and the index may be written anew at any time
    site.put("move.jsonl", [event(event_id="history_03_0001", event_ts="2031-04-20T08:00:00Z", ingest_ts="2031-05-01T00:00:00Z")])
    assert site.run().events == 1
    events.index.compact()
    site.put("move.jsonl", [event(event_id="history_03_0001", event_ts="2031-04-22T08:00:00Z", ingest_ts="2031-05-01T00:00:00Z")])
    assert site.run().events == 1
    rows = [r for r in site.rows("telemetry_enriched", ["event_id"]) if r["event_id"] == "history_03_0001"]
    assert [str(r["event_date"]) for r in rows] == ["2031-04-22"] and site.counts()[0] == 6000
    # a table that was filled without an index gets one
    hadoop.delete(spark, events.index.path)
    site.put("move.jsonl", [event(event_id="history_03_0001", event_ts="2031-04-23T08:00:00Z", ingest_ts="2031-05-01T00:00:00Z")])
    assert site.run().events == 1 and site.counts()[0] == 6000


def test_failure_before_the_ledger_is_repaired_by_a_rerun(site, monkeypatch):
    site.put("1.jsonl", sample_batch())
    table = type(site.house.ledger)
    monkeypatch.setattr(table, "append", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        site.run()
    monkeypatch.undo()
    assert site.ledger_size() == 0
    assert site.run().files == 1
    assert (site.counts(), site.ledger_size()) == ([7, 4, 2, 2, 1], 1)


def test_a_run_leaves_the_session_as_it_was(site, spark):
    site.put("1.jsonl", sample_batch())
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        site.run()
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert hours_of(site)[0] == (True, 13, 2)


def test_listing_from_outside(site, spark):
    site.put("1.jsonl", sample_batch())
    found = site.house.stage("candidates", list_files(spark, site.source))
    listing = with_etags(spark, site.source, found)
    assert site.run(listing=listing).files == 1
    assert site.run(listing=listing).status == "skipped"


def test_fingerprints_do_not_depend_on_splits(site, spark):
    lines = [event(event_id=f"unit_{i:06d}") for i in range(300)]
    site.put("1.jsonl", lines)

    def etag():
        found = site.house.stage("candidates", list_files(spark, site.source))
        return with_etags(spark, site.source, found).first()["etag"]

    whole = etag()
    with_small_splits = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in with_small_splits}
    try:
        for k, v in with_small_splits.items():
            spark.conf.set(k, v)
        found = site.house.stage("candidates", list_files(spark, site.source))
        assert read_lines(spark, site.source, found).select("block_start").distinct().count() > 5
        assert etag() == whole
        lines[10], lines[200] = lines[200], lines[10]
        site.put("1.jsonl", lines)
        assert etag() != whole
        site.put("1.jsonl", [*lines[:250], "", "{broken", *lines[250:]])
        with pytest.raises(BatchRejected, match="telemetry/1.jsonl line 252 "):
            site.run()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_many_problems_and_many_bad_files(site):
    bad = [event(event_id=f"unit_bad_{i:04d}", latitude=91 + i) for i in range(50)]
    for i in range(5):
        site.put(f"bad{i}.jsonl", bad[i * 10:i * 10 + 10] + [event(event_id=f"unit_fine_{i}")])
    site.put("good.jsonl", sample_batch())
    with pytest.raises(BatchRejected, match="50 x field 'latitude' is wrong"):
        site.run()
    assert problems(site)[0].startswith("unit_bad_0000: field 'latitude' is wrong")
    assert len(problems(site)) == 50
    result = site.run(quarantine_bad_files=True)
    assert (result.files, result.quarantined, result.events) == (1, 5, 7)
    assert site.counts() == [7, 4, 2, 2, 1]


def test_folders_inside_others_are_read_once(site, spark):
    site.put("x.jsonl", [event(event_id="outer_event")])
    site.put("a/y.jsonl", [event(event_id="inner_event")])
    site.put("a-b/z.jsonl", [event(event_id="other_event")])
    assert site.run().events == 3
    site.put("a/b/w.jsonl", [event(event_id="deeper_event")])
    site.put("a/v.jsonl", [event(event_id="second_event")])
    assert site.run().events == 2
    assert site.counts()[0] == 5


def test_numbers_are_padded_but_never_cut(spark):
    rows = [(123456789, 1), (123456780, 1234567), (7, 1234568)]
    df = spark.createDataFrame(rows, "event_id long, user_id long")
    ids = df.selectExpr(f"{adapter.event_id_sql('event_id')} AS e", f"{adapter.padded('user_id', 12)} AS v").collect()
    assert [tuple(r) for r in ids] == [
        ("evt_123456789", "000000000001"), ("evt_123456780", "000001234567"), ("evt_00000007", "000001234568")]
