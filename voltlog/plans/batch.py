"""One incremental run: find new files, check, build the five tables, upsert, record the files."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlog.operators import check, reports, transform
from voltlog.operators.lines import drop_blank, members_sql, number_lines
from voltlog.operators.merge import joined_by_number, recompute, touched_keys
from voltlog.schemas import ENRICHED, LEDGER, POSITION, QUARANTINE, STATES, TABLES
from voltlog.session import configured, footers
from voltlog.sources import files as fs
from voltlog.sources.lease import Lease, leased
from voltlog.sources.published import publish
from voltlog.sources.tables import AppendTable, CuratedTable, distinct_days


class BatchRejected(ValueError):
    """The batch has a problem; nothing of it was loaded."""


@dataclass(frozen=True)
class RunResult:
    """``postponed`` files hold ids that another new file brings too; the next run looks at them again."""

    status: str
    files: int = 0
    quarantined: int = 0
    events: int = 0
    postponed: int = 0


@dataclass(frozen=True)
class Warehouse:
    """Folder with curated tables, staging, ledger and quarantine."""

    spark: SparkSession
    path: str

    def table(self, name: str) -> CuratedTable:
        return CuratedTable.open(self.spark, self.path, TABLES[name])

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name).read() for name in TABLES}

    def row_counts(self) -> DataFrame:
        """Rows of the five tables, counted from the footers of their files."""
        with footers(self.spark):
            return reports.row_counts(self.tables())

    @property
    def ledger(self) -> AppendTable:
        return AppendTable(self.spark, f"{self.path}/raw/processed_files", LEDGER)

    @property
    def quarantine(self) -> AppendTable:
        return AppendTable(self.spark, f"{self.path}/raw/quarantined_files", QUARANTINE)

    def states(self, name: str) -> CuratedTable:
        """What the aggregates are kept as; runs that recompute them add new events to it."""
        return CuratedTable.open(self.spark, self.path, STATES[name], "states")

    @property
    def touched_groups(self) -> AppendTable:
        """Groups whose states are no longer right and must be built from their events."""
        groups = T.StructType([f for f in ENRICHED.fields if f.name in ("vin", "event_date", "event_hour")])
        return AppendTable(self.spark, f"{self.path}/raw/touched_groups", groups)

    def publish(self, database: str) -> None:
        publish(self.spark, self.path, database, self.ledger.path)

    def staged(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/staging/{name}")

    def stage(self, name: str, rows: DataFrame) -> DataFrame:
        """Replace a staging table and read it back: cuts the plan and gives Spark its size."""
        rows.write.mode("overwrite").parquet(f"{self.path}/staging/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/staging/{name}")


def run_batch(
    spark: SparkSession,
    source: fs.Source,
    warehouse_path: str,
    *,
    listing: DataFrame | None = None,
    recompute_aggregates: bool = False,
    quarantine_bad_files: bool = False,
    lease_seconds: float | None = 900.0,
    database: str | None = None,
) -> RunResult:
    """Load all files that were not loaded before.

    A run has the warehouse to itself by a lease (see ``sources.lease``): a second one is refused while the first
    goes on, and may begin ``lease_seconds`` after the first died. None does without, for stores that
    cannot give one; then only one run at a time may be started. With ``database``, the tables are found by name
    in Spark's catalog after the run.

    ``listing`` may bring the candidate files with their etags, such as an inventory of an
    object store, instead of listing the folders. The two options are off by
    default: aggregates come from the batch alone, and one bad file rejects the batch.
    """
    house = Warehouse(spark, warehouse_path.rstrip("/"))
    with configured(spark), leased(spark, f"{house.path}/leases", lease_seconds) as lease:
        result = _run(house, source, listing, recompute_aggregates, quarantine_bad_files, lease)
        if database:
            house.publish(database)
        return result


def _run(house: Warehouse, source: fs.Source, listing: DataFrame | None, recompute_aggregates: bool,
         quarantine_bad_files: bool, lease: Lease | None) -> RunResult:
    spark = house.spark
    found = house.stage("new_files", _find_new_files(spark, source, house, listing))
    files = found.count()
    if not files:
        return RunResult("skipped")
    raw = fs.read_lines(spark, source, found)
    checked = house.stage("checked_events", _with_derived(check.check_schema(drop_blank(raw))))
    counts = check.gate_counts(checked).first()
    if counts["lines"] == 0:
        raise BatchRejected("the new files have no events; remove the empty files from the source")
    bad = any(counts[name] for name in counts.asDict() if name != "lines")
    repeated = not check.repeated_ids(check.valid_rows(checked)).isEmpty()
    if not bad and not repeated:
        _load(house, checked, recompute_aggregates)
        _record(house, found, lease)
        return RunResult("loaded", files, 0, counts["lines"])
    if not quarantine_bad_files:
        _reject(house, source, found, checked, counts["broken"])
    aside = house.stage("quarantined_files", found.join(_own_problems(checked), "object_key"))
    good = house.stage("events_of_good_files", _without_files(checked, aside))
    late = check.later_duplicates(good).select("object_key").distinct()
    postponed = house.stage("postponed_files", found.join(late, "object_key", "left_semi"))
    good = _without_files(good, postponed)
    events = good.count()
    if events:
        _load(house, house.stage("events_to_load", good), recompute_aggregates)
    house.quarantine.append(aside.withColumn("quarantined_at", F.current_timestamp()))
    _record(house, _without_files(_without_files(found, aside), postponed), lease)
    gone, waiting = aside.count(), postponed.count()
    return RunResult("loaded", files - gone - waiting, gone, events, waiting)


def _find_new_files(spark, source: fs.Source, house: Warehouse, listing: DataFrame | None) -> DataFrame:
    seen = house.ledger.read().select("object_key", "etag").unionByName(
        house.quarantine.read().select("object_key", "etag")
    )
    if listing is None:
        listing = fs.with_etags(spark, source, house.stage("candidates", fs.list_files(spark, source)))
    return fs.new_files(listing.select(*fs.LISTING.names), seen).select(*fs.LISTING.names)


def _record(house: Warehouse, files: DataFrame, lease: Lease | None) -> None:
    """Last write of a run: after any failure before it, the same files are new again."""
    if lease:
        lease.check()
    house.ledger.append(files.withColumn("processed_at", F.current_timestamp()))


def _with_derived(checked: DataFrame) -> DataFrame:
    own = [c for c in checked.columns if c not in ENRICHED.names]
    return checked.select(*own, *transform.enriched_columns())


def _reject(house: Warehouse, source, found: DataFrame, checked: DataFrame, broken: int) -> None:
    if broken:
        raise BatchRejected(_broken_line(house.spark, source, found, checked))
    problems = house.stage("problems", check.problems(checked))
    rule = F.when(F.col("rule_no") == 0, F.regexp_extract("problem", ": (field '[^']*' is wrong)", 1)).otherwise(
        F.regexp_extract("problem", ".*: (.*)$", 1)
    )
    kinds = problems.groupBy("rule_no", rule.alias("rule")).count().orderBy("rule_no", "rule").collect()
    lines = [f"{r['count']} x {r['rule']}" for r in kinds]
    where = f"all sentences are in {house.path}/staging/problems"
    raise BatchRejected("\n".join(["data quality check failed:", *lines, where]))


def _broken_line(spark, source, found: DataFrame, checked: DataFrame) -> str:
    """Name the first broken line; only its file is read again, for the line number."""
    key = checked.where("broken").agg(F.min("object_key")).first()[0]
    numbered = number_lines(fs.read_lines(spark, source, found.where(F.col("object_key") == key)))
    broken = drop_blank(numbered).where(f"{members_sql('value')} is null")
    line_no = broken.agg(F.min("line_no")).first()[0]
    return f"{key} line {line_no} is not a valid JSON object"


def _own_problems(checked: DataFrame) -> DataFrame:
    """Files with problems that stay whatever other files hold, with their number and the first one.

    An id that occurs twice in one file is such a problem; an id that another file brings too is not.
    """
    broken = checked.where("broken").select(
        *POSITION, F.lit(-1).alias("rule_no"), F.lit("a line is not a valid JSON object").alias("problem")
    )
    inside = check.later_duplicates(
        check.valid_rows(checked).withColumn("event_id", F.struct("object_key", "event_id"))
    ).select(
        *POSITION, F.lit(1).alias("rule_no"),
        F.concat(F.col("event_id.event_id"), F.lit(": " + check.DUPLICATE)).alias("problem"),
    )
    every = (
        check.schema_problems(checked).unionByName(check.row_problems(checked)).unionByName(broken)
        .unionByName(inside)
    )
    order = F.struct("block_start", "row_id", "rule_no")
    return every.groupBy("object_key").agg(
        F.count(F.lit(1)).alias("problem_count"), F.min_by("problem", order).alias("first_problem")
    )


def _without_files(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of the other files. ``files`` is a written table, whose size Spark knows."""
    return rows.join(files.select("object_key"), "object_key", "left_anti").select(*rows.columns)


def _together(*steps):
    """Independent steps, whose Spark jobs may share the cluster."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for job in [pool.submit(step) for step in steps]:
            job.result()


def _load(house: Warehouse, checked: DataFrame, recompute_aggregates: bool) -> None:
    """Upsert the five tables from checked events.

    The gate has made sure that event ids are unique, and aggregates are unique by their
    grouping, so the upserts need not check their sources again.
    """
    enriched = checked.select(*ENRICHED.names)
    for name in TABLES:
        house.table(name).prepare_index()

    def put(name: str, rows: DataFrame, replaced: DataFrame | None = None) -> None:
        staged = house.stage(name, rows)
        house.table(name).upsert(staged, house.stage, replaced, keys_checked=True)

    def put_hourly(rows: DataFrame, replaced: DataFrame | None = None) -> None:
        put("vehicle_hourly_metrics", rows, replaced)

    def put_daily(rows: DataFrame, replaced: DataFrame | None = None) -> None:
        staged = house.stage("daily_metrics", rows)
        _together(
            lambda: put("trip_metrics", transform.trips_of(staged), replaced),
            lambda: put("battery_health", transform.battery_of(staged), replaced),
        )

    events = house.table("telemetry_enriched")
    if not recompute_aggregates:
        if house.states("hourly_states").exists:
            # these events go past the states: the next run that uses them looks at their groups anew
            changed = enriched.unionByName(events.replaced_rows(enriched).select(*ENRICHED.names))
            house.touched_groups.append(changed.select(*house.touched_groups.schema.names).distinct())
        _together(
            lambda: events.upsert(enriched, house.stage, keys_checked=True),
            lambda: put("alerts", transform.alerts(enriched)),
            lambda: put_hourly(transform.hourly_metrics(enriched)),
            lambda: put_daily(transform.daily_metrics(enriched)),
        )
        return

    # The aggregates come from all events, also those loaded earlier, so the events go first. What
    # they replace is noted before: a run that is repeated after a crash would not find it again,
    # so groups that lost events are kept in a table until the run is complete.
    pending = house.touched_groups
    if not house.states("hourly_states").exists:
        pending.append(events.read().select(*pending.schema.names).distinct())
    pending.append(events.replaced_rows(enriched).select(*pending.schema.names).distinct())
    lost = house.stage("replaced_events", pending.read().distinct())
    events.upsert(enriched, house.stage, keys_checked=True)

    def refresh(name: str, build: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
        """The states of the groups that the batch changes, and the keys of those groups."""
        table = house.states(name)
        keys = table.spec.keys
        lost_keys = house.stage(f"lost_{name}", lost.select(*keys).distinct())
        touched = house.stage(f"touched_{name}", touched_keys(enriched, lost_keys, keys))
        # A group that lost an event is built from all its events; to any other one, the new events are added.
        anew = recompute(build, events.read_days(distinct_days(lost_keys, table.spec.day)), lost_keys, keys)
        gone = joined_by_number(lost_keys)
        added = build(enriched.join(gone, list(keys), "left_anti").select(*enriched.columns))
        grown = touched.join(gone, list(keys), "left_anti")
        before = table.read_days(distinct_days(enriched, table.spec.day)).join(
            joined_by_number(grown, touched), list(keys), "left_semi"
        )
        merged = transform.merged_states(before.unionByName(added), keys)
        fresh = house.stage(name, anew.unionByName(merged))
        table.upsert(fresh, house.stage, touched, keys_checked=True)
        return fresh, touched

    def refresh_hourly() -> None:
        states, touched = refresh("hourly_states", transform.hourly_states)
        put_hourly(transform.hourly_of(states), touched)

    def refresh_daily() -> None:
        states, touched = refresh("daily_states", transform.daily_states)
        put_daily(transform.daily_of(states), touched)

    _together(lambda: put("alerts", transform.alerts(enriched)), refresh_hourly, refresh_daily)
    lost.limit(0).write.mode("overwrite").parquet(pending.path)
