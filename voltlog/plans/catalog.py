"""Named queries over the test tables, and the SQL that checks them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlog.operators import check, merge, reports, transform
from voltlog.operators.lines import members_sql, number_lines
from voltlog.plans import adapter
from voltlog.plans.batch import BatchRejected, Warehouse, run_batch
from voltlog.schemas import FIELD_NAMES, TABLES
from voltlog.session import configure, scratch_folder, unsorted_text
from voltlog.sources.files import Source, candidate_report, new_files
from voltlog.sources.jsonl import read_clean, to_lines, write_json_lines

Query = Callable[[SparkSession, str], DataFrame]

BUILDERS = {
    "telemetry_enriched": lambda enriched: enriched,
    "vehicle_hourly_metrics": transform.hourly_metrics,
    "trip_metrics": transform.trip_metrics,
    "battery_health": transform.battery_health,
    "alerts": transform.alerts,
}


# --- the five tables and what is read from them -------------------------------


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.enrich(adapter.telemetry(spark, sf_dir))


def _table(name: str) -> Query:
    return lambda spark, sf_dir: BUILDERS[name](_enriched(spark, sf_dir))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip and battery figures of a vehicle and day side by side, from one shuffle."""
    return transform.daily_metrics(_enriched(spark, sf_dir))


def _band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).groupBy("battery_band").agg(F.count(F.lit(1)).alias("events"))


def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.row_counts(transform.build_tables(adapter.telemetry(spark, sf_dir)))


# --- lines and checks ---------------------------------------------------------


@lru_cache(maxsize=4)
def _lines_folder(spark: SparkSession, sf_dir: str, defects: bool) -> str:
    folder = scratch_folder(spark)
    adapter.json_lines(adapter.telemetry(spark, sf_dir), defects).write.parquet(folder)
    return folder


def _lines(spark: SparkSession, sf_dir: str, defects: bool) -> DataFrame:
    """The events as written lines, so that reading them is a job of its own, as in a run."""
    return spark.read.parquet(_lines_folder(spark, sf_dir, defects))


def _parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check.clean_events(check.check_schema(_lines(spark, sf_dir, defects=False)))


@lru_cache(maxsize=4)
def _checked_folder(spark: SparkSession, sf_dir: str) -> str:
    """Checked lines with defects, written as a run does before it looks at the result."""
    folder = scratch_folder(spark)
    check.check_schema(_lines(spark, sf_dir, defects=True)).write.parquet(folder)
    return folder


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_checked_folder(spark, sf_dir))


@lru_cache(maxsize=4)
def _odd_folder(spark: SparkSession, sf_dir: str) -> str:
    """Checked lines of which some are written in an odd way, right or wrong."""
    folder = scratch_folder(spark)
    check.check_schema(adapter.odd_lines(adapter.telemetry(spark, sf_dir))).write.parquet(folder)
    return folder


def _odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_odd_folder(spark, sf_dir))


def _odd_line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check.clean_events(_odd(spark, sf_dir))


def _odd_line_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check.schema_problems(_odd(spark, sf_dir)).select("row_id", "problem")


def _problems_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = _odd(spark, sf_dir).where("error_field IS NOT NULL")
    return bad.groupBy("error_field").agg(F.count(F.lit(1)).alias("problems"))


def _broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no JSON object, with their numbers in the file."""
    raw = adapter.odd_lines(adapter.telemetry(spark, sf_dir))
    return number_lines(raw).where(f"{members_sql('value')} IS NULL").select("object_key", "row_id", "line_no")


def _sentences(build) -> Query:
    return lambda spark, sf_dir: build(_checked(spark, sf_dir)).select("row_id", "rule_no", "problem")


def _one_rule(rule_no: int) -> Query:
    return _sentences(lambda checked: check.row_problems(checked).where(F.col("rule_no") == rule_no))


def _clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check.clean_events(_checked(spark, sf_dir))


def _gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check.gate_counts(_checked(spark, sf_dir))


def _repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check.repeated_ids(check.valid_rows(_checked(spark, sf_dir)))


def _json_lines_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    write_json_lines(adapter.telemetry(spark, sf_dir), folder)
    return read_clean(spark, folder)


# --- files ----------------------------------------------------------------------


def _vehicle_files(events: DataFrame) -> DataFrame:
    """One file per vehicle; its fingerprint changes with the events it holds."""
    number = F.substring("event_id", 5, 20).cast("bigint")
    return events.groupBy("vin").agg(
        F.count(F.lit(1)).alias("n"), F.sum(number).alias("total")
    ).select(
        F.concat(F.lit("telemetry/"), "vin", F.lit("/events.jsonl")).alias("object_key"),
        F.md5(F.concat_ws("-", "n", "total").cast("binary")).alias("etag"),
    )


def _new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicles' files after both batches, against a ledger written after the first."""
    events = adapter.telemetry(spark, sf_dir)
    ledger = _vehicle_files(events.where(F.col("event_ts") < F.lit(adapter.SPLIT).cast("timestamp")))
    return new_files(_vehicle_files(events), ledger)


def _candidate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of candidate files of a folder per day, by folder; hidden names count like others."""
    root = scratch_folder(spark)
    source = Source(f"{root}/source", suffix=".txt")
    day = F.concat(F.when(F.dayofmonth("event_ts") % 2 == 0, "_").otherwise(""), F.to_date("event_ts").cast("string"))
    adapter.telemetry(spark, sf_dir).select(F.col("event_id").alias("value"), day.alias("day")).write.partitionBy(
        "day"
    ).text(source.folder)
    folder = F.regexp_extract("object_key", "^(.*)/[^/]*$", 1).alias("folder")
    return candidate_report(spark, source).groupBy(folder).agg(F.sum("length").alias("bytes"))


# --- upserts ---------------------------------------------------------------------


def _missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that would stop a load: those without a required column."""
    number = F.substring("event_id", 5, 20).cast("bigint")
    events = adapter.telemetry(spark, sf_dir).withColumn("vin", F.when(number % 50 != 7, F.col("vin")))
    events = events.withColumn("ingest_ts", F.when(number % 50 != 9, F.col("ingest_ts")))
    spec = TABLES["telemetry_enriched"]
    return merge.key_violations(events, spec.keys, spec.required)


def _enriched_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    first, second = adapter.batches(spark, sf_dir)
    return transform.enrich(first), transform.enrich(second)


def _upserted(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        first, second = _enriched_batches(spark, sf_dir)
        build = BUILDERS[name]
        return merge.upsert(build(first), build(second), TABLES[name].keys)

    return query


def _written(df: DataFrame) -> DataFrame:
    """As a run stages its tables: later steps read them instead of working them out again."""
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _recomputed(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        first, second = map(_written, _enriched_batches(spark, sf_dir))
        build, keys = BUILDERS[name], TABLES[name].keys
        ids = merge.joined_by_number(second.select("event_id"))
        replaced = first.join(ids, "event_id", "left_semi")
        touched = _written(merge.touched_keys(second, replaced, keys))
        events = merge.upsert(first, second, TABLES["telemetry_enriched"].keys, replaced=ids)
        fresh = merge.recompute(build, events, touched, keys)
        return merge.upsert(build(first), fresh, keys, replaced=merge.joined_by_number(touched))

    return query


def _key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that would stop a load: events of both batches put into one source."""
    first, second = adapter.batches(spark, sf_dir)
    return merge.key_violations(first.unionByName(second), ["event_id"])


# --- whole runs -------------------------------------------------------------------


@lru_cache(maxsize=4)
def _loaded(spark: SparkSession, sf_dir: str, recompute: bool) -> str:
    """A warehouse after a run for each of the two batches, read from JSON-lines files."""
    root = scratch_folder(spark)
    source = Source(f"{root}/source", suffix=".txt")
    for no, batch in enumerate(adapter.batches(spark, sf_dir, spread=True), start=1):
        day = F.to_date(F.get_json_object("value", "$.event_ts"))
        lines = to_lines(batch).withColumn("day", day)
        with unsorted_text(spark):
            lines.write.partitionBy("day").text(f"{source.folder}/batch={no}")
        run_batch(spark, source, f"{root}/warehouse", recompute_aggregates=recompute)
    return f"{root}/warehouse"


def _from_warehouse(read, recompute: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read(Warehouse(spark, _loaded(spark, sf_dir, recompute)))

    return query


def _catalog_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the five tables, and folders in the ledger, read by their names in the catalog."""
    house = Warehouse(spark, _loaded(spark, sf_dir, False))
    database = "voltlog_" + hashlib.md5(house.path.encode()).hexdigest()[:12]
    house.publish(database)
    counts = " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {database}.{name}" for name in TABLES)
    return spark.sql(f"""{counts} UNION ALL SELECT 'processed_files',
  count(DISTINCT regexp_extract(object_key, '^(.*)/[^/]*$', 1)) FROM {database}.processed_files""")


def _run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a series of runs does: loads, skips what it has loaded, refuses a bad batch and one without events."""
    root = scratch_folder(spark)
    source = Source(f"{root}/source", suffix=".txt")
    house = Warehouse(spark, f"{root}/warehouse")
    day = F.to_date(F.get_json_object("value", "$.event_ts"))
    bad = adapter.json_lines(adapter.telemetry(spark, sf_dir, spread=True), defects=True).select("value")
    lines = [to_lines(batch) for batch in adapter.batches(spark, sf_dir, spread=True)]
    blank = lines[0].limit(1).select(F.lit("  ").alias("value"), F.lit("blank").alias("day"))
    steps = [None, lines[0], None, lines[1], bad, blank]
    rows = []
    for no, put in enumerate(steps):
        if put is not None:
            put = put if "day" in put.columns else put.withColumn("day", F.coalesce(day.cast("string"), F.lit("none")))
            with unsorted_text(spark):
                put.repartition("day").write.partitionBy("day").mode("overwrite").text(f"{source.folder}/step={min(no, 4)}")
        try:
            result = run_batch(spark, source, house.path)
            outcome = (result.status, result.files, result.events)
        except BatchRejected as error:
            outcome = ("no events" if "no events" in str(error) else "rejected", 0, 0)
        tables = (house.table("telemetry_enriched").read().count(), house.ledger.read().count())
        late = house.ledger.read().where(F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("processed_at")) > 3600)
        rows.append((no, *outcome, *tables, late.count()))
    return spark.createDataFrame(
        rows, "step bigint, status string, files bigint, events bigint, stored bigint, recorded bigint, wrong_times bigint"
    )


def _loaded_table(name: str, recompute: bool = False) -> Query:
    return _from_warehouse(lambda house: house.table(name).read(), recompute)


def _folders(files: DataFrame) -> DataFrame:
    """Folders of recorded files, with the number of keys that are recorded more than once."""
    entries = files.groupBy("object_key", "etag").agg(F.count(F.lit(1)).alias("n"))
    folder = F.regexp_extract("object_key", "^(.*)/[^/]*$", 1)
    return entries.groupBy(folder.alias("folder")).agg(F.count_if(F.col("n") > 1).alias("repeated"))


@lru_cache(maxsize=4)
def _quarantined(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse after a run over a hundred files, some with odd lines, that sets bad files aside."""
    root = scratch_folder(spark)
    source = Source(f"{root}/source", suffix=".txt")
    lines = adapter.odd_lines(adapter.telemetry(spark, sf_dir, spread=True))
    file = (F.col("row_id") % 100).alias("file")
    with unsorted_text(spark):
        lines.select("value", file).repartition("file").write.partitionBy("file").text(source.folder)
    run_batch(spark, source, f"{root}/warehouse", quarantine_bad_files=True)
    return f"{root}/warehouse"


def _quarantined_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = Warehouse(spark, _quarantined(spark, sf_dir)).quarantine.read()
    return files.select(F.regexp_extract("object_key", "^(.*)/[^/]*$", 1).alias("folder"), "problem_count")


def _files_beside_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folders(Warehouse(spark, _quarantined(spark, sf_dir)).ledger.read())


def _events_beside_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Warehouse(spark, _quarantined(spark, sf_dir)).table("telemetry_enriched").read()


QUERIES: dict[str, Query] = {
    **{name: _table(name) for name in TABLES},
    "moving_events": lambda spark, sf_dir: transform.moving_events(_enriched(spark, sf_dir)),
    "daily_metrics": _daily,
    "battery_band_counts": _band_counts,
    "curated_row_counts": _row_counts,
    "events_by_time": lambda spark, sf_dir: reports.events_by_time(_enriched(spark, sf_dir)),
    "events_by_vehicle": lambda spark, sf_dir: reports.by_vehicle_and_time(_enriched(spark, sf_dir)),
    "parsed_lines": _parsed_lines,
    "json_lines_round_trip": _json_lines_round_trip,
    "clean_events": _clean_events,
    "schema_problems": _sentences(check.schema_problems),
    "duplicate_events": _sentences(check.duplicate_problems),
    "time_order_problems": _one_rule(2),
    "odometer_problems": _one_rule(3),
    "alert_code_problems": _one_rule(4),
    "batch_problems": _sentences(check.problems),
    "gate_counts": _gate_counts,
    "repeated_ids": _repeated_ids,
    "new_files": _new_files,
    "candidate_files": _candidate_files,
    "missing_keys": _missing_keys,
    "run_outcomes": _run_outcomes,
    "catalog_row_counts": _catalog_row_counts,
    **{f"upsert_{name}": _upserted(name) for name in TABLES},
    **{f"recompute_{name}": _recomputed(name)
       for name in ("vehicle_hourly_metrics", "trip_metrics", "battery_health")},
    "key_violations": _key_violations,
    **{f"loaded_{name}": _loaded_table(name) for name in TABLES},
    "loaded_row_counts": _from_warehouse(lambda house: house.row_counts()),
    "loaded_files": _from_warehouse(lambda house: _folders(reports.loaded_files(house.ledger.read()))),
    "odd_line_events": _odd_line_events,
    "odd_line_problems": _odd_line_problems,
    "problems_by_field": _problems_by_field,
    "broken_lines": _broken_lines,
    "quarantined_files": _quarantined_files,
    "files_beside_quarantine": _files_beside_quarantine,
    "events_beside_quarantine": _events_beside_quarantine,
    **{f"loaded_recomputed_{name}": _loaded_table(name, recompute=True)
       for name in ("vehicle_hourly_metrics", "trip_metrics", "battery_health")},
}


def forget_written_tables() -> None:
    """Make the next query write its intermediate tables anew."""
    _lines_folder.cache_clear()
    _checked_folder.cache_clear()
    _odd_folder.cache_clear()
    _loaded.cache_clear()
    _quarantined.cache_clear()


def queries() -> dict[str, Query]:
    def prepared(query: Query) -> Query:
        return lambda spark, sf_dir: adapter.comparable(query(configure(spark), sf_dir))

    return {name: prepared(query) for name, query in QUERIES.items()}


# --- checking SQL -------------------------------------------------------------------

_TELEM = f"telem AS ({adapter.TELEMETRY_SQL})"
_DERIVED = """*, cast(event_ts AS date) AS event_date, date_trunc('hour', event_ts) AS event_hour,
  speed_mph > 1 AS is_moving, lower(charging_state) = 'charging' AS is_charging,
  CASE WHEN battery_soc <= 20 THEN 'critical' WHEN battery_soc <= 50 THEN 'low'
       WHEN battery_soc <= 80 THEN 'normal' ELSE 'high' END AS battery_band"""


def _enriched_sql(source: str) -> str:
    return f"SELECT {_DERIVED} FROM {source}"


def _hourly_sql(source: str) -> str:
    return f"""SELECT vin, event_hour, count(event_id) AS events,
  round(avg(speed_mph), 6) AS avg_speed_mph, max(speed_mph) AS max_speed_mph,
  round(avg(battery_soc), 6) AS avg_battery_soc, min(battery_soc) AS min_battery_soc,
  max(battery_temp_c) AS max_battery_temp_c, count(*) FILTER (WHERE is_moving) AS moving_events,
  count(*) FILTER (WHERE is_charging) AS charging_events, max(odometer_miles) AS latest_odometer_miles
FROM {source} GROUP BY vin, event_hour"""


def _trips_sql(source: str) -> str:
    return f"""SELECT vin, event_date, min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts,
  min(odometer_miles) AS start_odometer_miles, max(odometer_miles) AS end_odometer_miles,
  round(avg(speed_mph), 6) AS avg_speed_mph, max(speed_mph) AS max_speed_mph,
  count(*) FILTER (WHERE autopilot_engaged) AS autopilot_events,
  round(max(odometer_miles) - min(odometer_miles), 6) AS distance_miles
FROM {source} WHERE is_moving GROUP BY vin, event_date"""


def _battery_sql(source: str) -> str:
    return f"""SELECT vin, event_date, round(avg(battery_soc), 6) AS avg_battery_soc,
  min(battery_soc) AS min_battery_soc, round(avg(battery_temp_c), 6) AS avg_battery_temp_c,
  max(battery_temp_c) AS max_battery_temp_c, count(*) FILTER (WHERE is_charging) AS charge_events
FROM {source} GROUP BY vin, event_date"""


_TABLE_SQL = {
    "telemetry_enriched": lambda source: f"SELECT * FROM {source}",
    "vehicle_hourly_metrics": _hourly_sql,
    "trip_metrics": _trips_sql,
    "battery_health": _battery_sql,
    "alerts": lambda source: f"SELECT * FROM {source} WHERE event_type = 'alert'",
}
_ALL = f"WITH {_TELEM}, enriched AS ({_enriched_sql('telem')})"
_BATCHES = f"""WITH {_TELEM}, {adapter.SPLIT_SQL},
e1 AS ({_enriched_sql('first_batch')}), e2 AS ({_enriched_sql('second_batch')}),
merged AS (SELECT * FROM e2 UNION ALL
           SELECT * FROM e1 WHERE event_id NOT IN (SELECT event_id FROM e2))"""


def _upsert_sql(name: str) -> str:
    same = " AND ".join(f"t1.{key} = t2.{key}" for key in TABLES[name].keys)
    build = _TABLE_SQL[name]
    return f"""{_BATCHES}, t1 AS ({build('e1')}), t2 AS ({build('e2')})
SELECT * FROM t2 UNION ALL
SELECT * FROM t1 WHERE NOT EXISTS (SELECT 1 FROM t2 WHERE {same})"""


# The lines as the defects leave them: n is the line, place the position in its hundred.
_LINES = f"""WITH {_TELEM}, numbered AS (
  SELECT *, cast(substr(event_id, 5) AS bigint) AS n, cast(substr(event_id, 5) AS bigint) % 100 AS place
  FROM telem
), lines AS (
  SELECT n, place,
    CASE place WHEN 5 THEN {adapter.event_id_sql('(n - 5)')} ELSE event_id END AS event_id,
    vin, event_ts,
    CASE place WHEN 2 THEN event_ts - INTERVAL '10' SECOND ELSE ingest_ts END AS ingest_ts,
    CASE place WHEN 4 THEN 'alert' ELSE event_type END AS event_type,
    latitude, longitude,
    CASE place WHEN 3 THEN cast(10 AS double) ELSE speed_mph END AS speed_mph,
    battery_soc, battery_temp_c,
    CASE place WHEN 3 THEN cast(0 AS double) ELSE odometer_miles END AS odometer_miles,
    charging_state, gear,
    CASE place WHEN 11 THEN true ELSE autopilot_engaged END AS autopilot_engaged,
    CASE place WHEN 4 THEN NULL ELSE alert_code END AS alert_code, software_version
  FROM numbered
), valid AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY n) AS occurrence
  FROM lines WHERE place NOT IN (1, 6, 7, 8, 9)
)"""
_SCHEMA_PROBLEMS = """SELECT n AS row_id, 0 AS rule_no, event_id || ': field ''' ||
  CASE place WHEN 1 THEN 'battery_soc'' is wrong: Input should be less than or equal to 100'
             WHEN 6 THEN 'vin'' is wrong: Value error, VIN cannot contain spaces'
             WHEN 7 THEN 'event_ts'' is wrong: Input should have timezone info'
             WHEN 8 THEN 'note'' is wrong: Extra inputs are not permitted'
             ELSE 'gear'' is wrong: Field required' END AS problem
FROM lines WHERE place IN (1, 6, 7, 8, 9)"""


def _rule_sql(rule_no: int, condition: str, sentence: str) -> str:
    return (f"SELECT n AS row_id, {rule_no} AS rule_no, event_id || ': {sentence}' AS problem "
            f"FROM valid WHERE {condition}")


_RULES = {
    "schema_problems": _SCHEMA_PROBLEMS,
    "duplicate_events": _rule_sql(1, "occurrence > 1", check.DUPLICATE),
    "time_order_problems": _rule_sql(2, "event_ts > ingest_ts", check.TOO_EARLY),
    "odometer_problems": _rule_sql(3, "speed_mph > 0 AND odometer_miles = 0", check.NO_ODOMETER),
    "alert_code_problems": _rule_sql(
        4, "event_type = 'alert' AND coalesce(alert_code, '') = ''", check.NO_ALERT_CODE),
}


def _odd_sql() -> str:
    """Numbers of odd lines with the field and the error; no error: accepted, empty: broken."""
    text = lambda t: "NULL" if t is None else "'" + t.replace("'", "''") + "'"
    # an unknown field is reported by its own name
    named = [("extra" if e == "Extra inputs are not permitted" else f, e) for f, _, _, e in adapter.ODD_LINES]
    values = ", ".join(f"({i + adapter.FIRST_ODD}, {text(f)}, {text(e)})" for i, (f, e) in enumerate(named))
    return f"""WITH {_TELEM}, odd(place, field, error) AS (VALUES {values}),
numbered AS (SELECT *, cast(substr(event_id, 5) AS bigint) AS n FROM telem),
lines AS (SELECT numbered.*, field, error FROM numbered LEFT JOIN odd ON n % 1000 = place)"""


_SHOWN_ID = f"""CASE n % 1000 WHEN {adapter.FIRST_ODD} THEN 'evt_1' WHEN {adapter.FIRST_ODD + 1} THEN '12345678'
  ELSE event_id END"""
_BAD_BUCKETS = "SELECT DISTINCT n % 100 FROM lines WHERE error IS NOT NULL"


def _vehicle_files_sql(source: str) -> str:
    return f"""SELECT 'telemetry/' || vin || '/events.jsonl' AS object_key,
  md5(cast(count(*) AS string) || '-' || cast(sum(cast(substr(event_id, 5) AS bigint)) AS string)) AS etag
FROM {source} GROUP BY vin"""


def _counts_sql(prefix: str, sources: dict[str, str]) -> str:
    return prefix + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({sql})" for name, sql in sources.items()
    )


def _merged_counts_sql() -> str:
    tables = ", ".join(
        f"{name} AS ({_strip_prefix(_upsert_sql(name))})" for name in TABLES
    )
    return _counts_sql(f"{_BATCHES}, {tables} ", {name: f"SELECT * FROM {name}" for name in TABLES})


def _run_outcomes_sql() -> str:
    """The series of runs; files are days, as each day of a batch is one file."""
    days, rows = "(SELECT count(DISTINCT event_date) FROM {})", "(SELECT count(*) FROM {})"
    d1, d2, r1, r2, both = (days.format("e1"), days.format("e2"), rows.format("e1"), rows.format("e2"), rows.format("merged"))
    steps = [
        ("skipped", 0, 0, 0, 0), ("loaded", d1, r1, r1, d1), ("skipped", 0, 0, r1, d1),
        ("loaded", d2, r2, both, f"{d1} + {d2}"), ("rejected", 0, 0, both, f"{d1} + {d2}"),
        ("no events", 0, 0, both, f"{d1} + {d2}"),
    ]
    return f"{_BATCHES} " + " UNION ALL ".join(
        f"SELECT cast({no} AS bigint) AS step, '{status}' AS status, cast({files} AS bigint) AS files, "
        f"cast({events} AS bigint) AS events, cast({stored} AS bigint) AS stored, cast({recorded} AS bigint) AS recorded, "
        "cast(0 AS bigint) AS wrong_times"
        for no, (status, files, events, stored, recorded) in enumerate(steps)
    )


def _strip_prefix(sql: str) -> str:
    return "WITH" + sql.removeprefix(_BATCHES).removeprefix(",")


def oracle_sql() -> dict[str, str]:
    columns = ", ".join(FIELD_NAMES)
    sql = {name: f"{_ALL} {build('enriched')}" for name, build in _TABLE_SQL.items()}
    sql |= {
        "moving_events": f"{_ALL} SELECT * FROM enriched WHERE is_moving",
        "daily_metrics": f"""{_ALL}, trips AS ({_trips_sql('enriched')}), battery AS ({_battery_sql('enriched')}),
moving AS (SELECT vin, event_date, count(*) FILTER (WHERE is_moving) AS moving_events
           FROM enriched GROUP BY vin, event_date)
SELECT vin, event_date, moving_events, first_event_ts, last_event_ts, start_odometer_miles,
  end_odometer_miles, avg_speed_mph, max_speed_mph, coalesce(autopilot_events, 0) AS autopilot_events,
  avg_battery_soc, min_battery_soc, avg_battery_temp_c, max_battery_temp_c, charge_events, distance_miles
FROM battery JOIN moving USING (vin, event_date) LEFT JOIN trips USING (vin, event_date)""",
        "battery_band_counts":
            f"{_ALL} SELECT battery_band, count(*) AS events FROM enriched GROUP BY battery_band",
        "curated_row_counts": _counts_sql(
            _ALL + " ", {name: build("enriched") for name, build in _TABLE_SQL.items()}),
        "events_by_time": f"{_ALL} SELECT * FROM enriched ORDER BY event_ts, event_id",
        "events_by_vehicle": f"{_ALL} SELECT * FROM enriched ORDER BY vin, event_ts",
        "parsed_lines": f"WITH {_TELEM} SELECT * FROM telem",
        "json_lines_round_trip": f"WITH {_TELEM} SELECT * FROM telem",
        "clean_events": f"{_LINES} SELECT {columns} FROM valid",
        "batch_problems": f"{_LINES} " + " UNION ALL ".join(_RULES.values()),
        "gate_counts": f"""{_LINES} SELECT count(*) AS lines, cast(0 AS bigint) AS broken,
  count(*) FILTER (WHERE place IN (1, 6, 7, 8, 9)) AS schema,
  (SELECT count(*) FROM valid WHERE event_ts > ingest_ts) AS too_early,
  (SELECT count(*) FROM valid WHERE speed_mph > 0 AND odometer_miles = 0) AS no_odometer,
  (SELECT count(*) FROM valid WHERE event_type = 'alert' AND alert_code IS NULL) AS no_alert_code
FROM lines""",
        "repeated_ids": f"""{_LINES} SELECT event_id, count(*) AS occurrences FROM valid GROUP BY event_id HAVING count(*) > 1""",
        "new_files": f"""WITH {_TELEM}, {adapter.SPLIT_SQL}, files AS ({_vehicle_files_sql('telem')}),
ledger AS ({_vehicle_files_sql('first_batch')})
SELECT * FROM files WHERE NOT EXISTS
  (SELECT 1 FROM ledger WHERE ledger.object_key = files.object_key AND ledger.etag = files.etag)""",
        "key_violations": f"""WITH {_TELEM}, {adapter.SPLIT_SQL}
SELECT event_id, count(*) AS row_count, cast(0 AS bigint) AS missing_count
FROM (SELECT * FROM first_batch UNION ALL SELECT * FROM second_batch) both_batches
GROUP BY event_id HAVING count(*) > 1""",
        "candidate_files": f"""WITH {_TELEM} SELECT 'telemetry/day=' ||
  CASE WHEN day(event_ts) % 2 = 0 THEN '_' ELSE '' END || cast(cast(event_ts AS date) AS string) AS folder,
  cast(sum(length(event_id) + 1) AS bigint) AS bytes FROM telem GROUP BY folder""",
        "missing_keys": f"""WITH {_TELEM} SELECT event_id, cast(1 AS bigint) AS row_count, cast(1 AS bigint) AS missing_count
FROM telem WHERE cast(substr(event_id, 5) AS bigint) % 50 IN (7, 9)""",
        "run_outcomes": _run_outcomes_sql(),
        "catalog_row_counts": f"""{_merged_counts_sql()} UNION ALL
SELECT 'processed_files' AS table_name, (SELECT count(DISTINCT event_date) FROM e1) + (SELECT count(DISTINCT event_date) FROM e2)""",
        "loaded_row_counts": _merged_counts_sql(),
        "loaded_files": f"""{_BATCHES}, days AS (
  SELECT DISTINCT 1 AS batch, event_date FROM e1 UNION ALL SELECT DISTINCT 2 AS batch, event_date FROM e2)
SELECT 'telemetry/batch=' || cast(batch AS string) || '/day=' || cast(event_date AS string) AS folder,
  cast(0 AS bigint) AS repeated FROM days""",
        "odd_line_events": f"{_odd_sql()} SELECT {columns} FROM lines WHERE error IS NULL",
        "odd_line_problems": f"""{_odd_sql()} SELECT n AS row_id, {_SHOWN_ID} || ': field ' || chr(39) || field
  || chr(39) || ' is wrong: ' || error AS problem FROM lines WHERE error <> ''""",
        "problems_by_field": f"""{_odd_sql()} SELECT field AS error_field, count(*) AS problems
FROM lines WHERE error <> '' GROUP BY field""",
        "broken_lines": f"""{_odd_sql()} SELECT 'telemetry/events.jsonl' AS object_key, n AS row_id,
  n - (SELECT min(n) FROM lines) + 1 AS line_no FROM lines WHERE error = ''""",
        "quarantined_files": f"""{_odd_sql()} SELECT 'telemetry/file=' || cast(n % 100 AS string) AS folder,
  count(*) AS problem_count FROM lines WHERE error IS NOT NULL GROUP BY n % 100""",
        "files_beside_quarantine": f"""{_odd_sql()}
SELECT DISTINCT 'telemetry/file=' || cast(n % 100 AS string) AS folder, cast(0 AS bigint) AS repeated
FROM lines WHERE n % 100 NOT IN ({_BAD_BUCKETS})""",
        "events_beside_quarantine": f"""{_odd_sql()}, kept AS (
  SELECT {columns} FROM lines WHERE n % 100 NOT IN ({_BAD_BUCKETS})) {_enriched_sql('kept')}""",
    }
    sql |= {name: f"{_LINES} {rule}" for name, rule in _RULES.items()}
    for name in TABLES:
        sql[f"upsert_{name}"] = sql[f"loaded_{name}"] = _upsert_sql(name)
    for name in ("vehicle_hourly_metrics", "trip_metrics", "battery_health"):
        sql[f"recompute_{name}"] = sql[f"loaded_recomputed_{name}"] = (
            f"{_BATCHES} {_TABLE_SQL[name]('merged')}"
        )
    return sql
