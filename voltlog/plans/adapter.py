"""The generic ``events`` table seen as vehicle telemetry.

The same SQL text runs in Spark and in the engine that checks the results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlog.functions.derive import iso_utc
from voltlog.schemas import EVENT, FIELD_NAMES

def padded(number: str, digits: int) -> str:
    """SQL text of a number with leading zeros; unlike a plain ``lpad`` it never cuts digits off."""
    text = f"cast({number} AS string)"
    return f"lpad({text}, cast(greatest({digits}, length({text})) AS int), '0')"


def event_id_sql(number: str) -> str:
    return f"'evt_' || {padded(number, 8)}"


# Four letters and twelve digits; the contract leaves room for a thirteenth and refuses more.
VIN_START = "VLTX"
TELEMETRY_SQL = """
SELECT
  {event_id}                                                     AS event_id,
  {vin}                                                          AS vin,
  ts                                                             AS event_ts,
  ts + INTERVAL '10' SECOND                                      AS ingest_ts,
  CASE event_type WHEN 'error' THEN 'alert'
                  WHEN 'purchase' THEN 'charge'
                  ELSE 'telemetry' END                           AS event_type,
  cast(user_id % 181 - 90 AS double)                             AS latitude,
  cast(event_id % 361 - 180 AS double)                           AS longitude,
  CASE WHEN event_type = 'purchase' THEN cast(0 AS double)
       ELSE least(value, cast(180 AS double)) END                AS speed_mph,
  cast(regexp_extract(props, '[0-9]+', 0) AS double) + 1         AS battery_soc,
  cast(event_id % 131 - 40 AS double)                            AS battery_temp_c,
  cast(1000 + event_id AS double)                                AS odometer_miles,
  CASE WHEN event_type <> 'purchase' THEN 'Disconnected'
       WHEN event_id % 2 = 0 THEN 'Charging' ELSE 'CHARGING' END AS charging_state,
  CASE WHEN event_type = 'purchase' THEN 'P' ELSE 'D' END        AS gear,
  event_id % 3 = 0                                               AS autopilot_engaged,
  CASE WHEN event_type = 'error'
       THEN 'CODE_' || cast(event_id % 5 AS string) END          AS alert_code,
  'build-7041'                                                   AS software_version
FROM events
""".format(event_id=event_id_sql("event_id"), vin=f"'{VIN_START}' || {padded('user_id', 12)}")

# First batch: events before this time. Second batch: the others, and corrections of
# first-batch events of one kind, which move to the next day with a lower charge.
SPLIT = "2024-01-16 00:00:00"
SPLIT_SQL = f"""
first_batch AS (
  SELECT * FROM telem WHERE event_ts < TIMESTAMP '{SPLIT}'
),
corrected AS (
  SELECT event_id, vin, event_ts + INTERVAL '1' DAY AS event_ts,
         ingest_ts + INTERVAL '1' DAY AS ingest_ts, 'telemetry' AS event_type,
         latitude, longitude, speed_mph, battery_soc / 2 AS battery_soc, battery_temp_c,
         odometer_miles, charging_state, gear, autopilot_engaged, alert_code, software_version
  FROM first_batch WHERE alert_code = 'CODE_3'
),
second_batch AS (
  SELECT * FROM telem WHERE event_ts >= TIMESTAMP '{SPLIT}'
  UNION ALL SELECT * FROM corrected
)
"""


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def telemetry(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Events with instants; the session runs in UTC, so the clock reading stays the same.

    With ``spread``, rows are dealt out first, so that few large parts of a file do not make few long tasks.
    """
    events = events_table(spark, sf_dir)
    if spread:
        events = events.repartition("event_id")
    return as_instants(spark.sql(TELEMETRY_SQL.replace("FROM events", "FROM {events}"), events=events))


def batches(spark: SparkSession, sf_dir: str, spread: bool = False) -> tuple[DataFrame, DataFrame]:
    events = telemetry(spark, sf_dir, spread)
    split = F.lit(SPLIT).cast("timestamp")
    first = events.where(F.col("event_ts") < split)
    day = F.expr("INTERVAL '1' DAY")
    corrected = first.where("alert_code = 'CODE_3'").select(
        *[
            (F.col(c) + day if c.endswith("_ts")
             else F.lit("telemetry") if c == "event_type"
             else F.col(c) / 2 if c == "battery_soc"
             else F.col(c)).alias(c)
            for c in FIELD_NAMES
        ]
    )
    return first, events.where(F.col("event_ts") >= split).unionByName(corrected)


def as_instants(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT.fields])


def comparable(df: DataFrame) -> DataFrame:
    """Times without zone and measured values with six decimals, as the check expects them."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() == "timestamp":
            c = c.cast("timestamp_ntz")
        elif f.name.startswith("avg_") or f.name == "distance_miles":
            c = F.round(c, 6)
        columns.append(c.alias(f.name))
    return df.select(*columns)


def json_lines(events: DataFrame, defects: bool = False) -> DataFrame:
    """Raw lines of the events, all as one file in order of the event number.

    With ``defects``, every hundred consecutive events bring one of each defect listed
    below and three unusual but valid spellings.
    """
    number = F.substring("event_id", 5, 20).cast("bigint")
    fields = {f: F.col(f) for f in FIELD_NAMES}
    fields["event_ts"] = iso_utc(F.col("event_ts"))
    fields["ingest_ts"] = iso_utc(F.col("ingest_ts"))
    if not defects:
        line = F.to_json(_record(fields), {"ignoreNullFields": "false"})
        return _as_raw(events, number, line)
    place = F.pmod(number, F.lit(100))
    at = lambda n, value, name: F.when(place == n, value).otherwise(fields[name])
    clock = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    shifted = iso_utc(F.col("event_ts") + F.expr("INTERVAL 330 MINUTES"))
    shown_in_india = F.replace(shifted, F.lit("Z"), F.lit("+05:30"))
    changed = {
        **fields,
        "battery_soc": at(1, F.lit(120.0), "battery_soc"),
        "ingest_ts": at(2, iso_utc(F.col("event_ts") - F.expr("INTERVAL 10 SECONDS")), "ingest_ts"),
        "speed_mph": at(3, F.lit(10.0), "speed_mph"),
        "odometer_miles": at(3, F.lit(0.0), "odometer_miles"),
        "event_type": at(4, F.lit("alert"), "event_type"),
        "alert_code": at(4, F.lit(None).cast("string"), "alert_code"),
        "event_id": at(
            5, F.expr(event_id_sql("(cast(substr(event_id, 5) AS bigint) - 5)")), "event_id"
        ),
        "vin": at(6, F.concat(F.left("vin", F.lit(2)), F.lit(" "), F.substring("vin", 4, 20)), "vin"),
        "event_ts": F.when(place == 7, clock(F.col("event_ts")))
        .when(place == 12, shown_in_india)
        .otherwise(fields["event_ts"]),
    }
    keep_null = {"ignoreNullFields": "false"}
    line = (
        F.when(place == 8, F.to_json(F.struct(*_columns(changed), F.lit("x").alias("note")), keep_null))
        .when(place == 9, F.to_json(_record({k: v for k, v in changed.items() if k != "gear"}), keep_null))
        .when(place == 10, F.to_json(
            _record({**changed, "speed_mph": fields["speed_mph"].cast("string")}), keep_null))
        .when(place == 11, F.to_json(_record({**changed, "autopilot_engaged": F.lit("yes")}), keep_null))
        .otherwise(F.to_json(_record(changed), keep_null))
    )
    return _as_raw(events, number, line)


# Unusual lines, each as the contract field it is about, a pattern in the plain line, what
# takes its place, and the error (None: accepted with the plain line's values; "": a broken line).
_TEXT, _NUMBER = '"%s":"[^"]*"', '"%s":-?[0-9.]+'
ODD_LINES = (
    ("event_id", _TEXT, '"%s":"evt_1"', "String should have at least 8 characters"),
    ("event_id", _TEXT, '"%s":12345678', "Input should be a valid string"),
    ("vin", _TEXT, '"%s":"VLTX000001"', "String should have at least 11 characters"),
    ("vin", _TEXT, '"%s":"VLTX00000000000001"', "String should have at most 17 characters"),
    ("vin", '"%s":"VLTX00', '"%s":"VLTX 0', "Value error, VIN cannot contain spaces"),
    ("event_ts", '"%s":"([^"]*)Z"', '"%s":"$1"', "Input should have timezone info"),
    ("ingest_ts", '"%s":"([^"]*)Z"', '"%s":"$1"', "Input should have timezone info"),
    ("ingest_ts", _TEXT, '"%s":"soon"', "Input should be a valid datetime"),
    ("event_type", _TEXT, '"%s":"ALERT"', "Input should be 'telemetry', 'charge' or 'alert'"),
    ("latitude", _NUMBER, '"%s":90.5', "Input should be less than or equal to 90"),
    ("latitude", _NUMBER, '"%s":-90.5', "Input should be greater than or equal to -90"),
    ("longitude", _NUMBER, '"%s":180.5', "Input should be less than or equal to 180"),
    ("longitude", _NUMBER, '"%s":-180.5', "Input should be greater than or equal to -180"),
    ("speed_mph", _NUMBER, '"%s":180.5', "Input should be less than or equal to 180"),
    ("speed_mph", _NUMBER, '"%s":-0.5', "Input should be greater than or equal to 0"),
    ("battery_soc", _NUMBER, '"%s":100.5', "Input should be less than or equal to 100"),
    ("battery_soc", _NUMBER, '"%s":-0.5', "Input should be greater than or equal to 0"),
    ("battery_temp_c", _NUMBER, '"%s":90.5', "Input should be less than or equal to 90"),
    ("battery_temp_c", _NUMBER, '"%s":-40.5', "Input should be greater than or equal to -40"),
    ("odometer_miles", _NUMBER, '"%s":-0.5', "Input should be greater than or equal to 0"),
    ("latitude", _NUMBER, '"%s":"north"', "Input should be a valid number, unable to parse string as a number"),
    ("charging_state", _TEXT, '"%s":true', "Input should be a valid string"),
    ("gear", _TEXT, '"%s":5', "Input should be a valid string"),
    ("software_version", _TEXT, '"%s":null', "Input should be a valid string"),
    ("software_version", ',"%s":"[^"]*"', "", "Field required"),
    ("alert_code", '"%s":(null|"[^"]*")', '"%s":7', "Input should be a valid string"),
    ("autopilot_engaged", '"%s":(true|false)', '"%s":"maybe"',
     "Input should be a valid boolean, unable to interpret input"),
    ("autopilot_engaged", '"%s":(true|false)', '"%s":null', "Input should be a valid boolean"),
    ("longitude", '"%s":-?[0-9.]+(.*)"gear":"[^"]*"', '"%s":200$1"gear":5', "Input should be less than or equal to 180"),
    ("gear", '"%s":"([^"]*)"', '"%s":"$1","extra":1,"more":2', "Extra inputs are not permitted"),
    ("vin", '"%s":"VLTX', '"%s":"vltx', None),
    ("vin", '"%s":"', '"%s":" ', None),
    ("event_ts", '"%s":"([^T]*)T([^Z]*)Z"', '"%s":"$1t$2z"', None),
    ("battery_soc", '"%s":([0-9.]+)', '"%s":" $1 "', None),
    ("autopilot_engaged", '"%s":(true|false)', '"%s":"$1"', None),
    ("alert_code", '"%s":null,', "", None),
    ("", "[}]$", "} trailing", ""),
    ("", "[}]$", "", ""),
    ("", "^(.*)$", "[$1]", ""),
)
FIRST_ODD = 20


def odd_lines(events: DataFrame) -> DataFrame:
    """Raw lines as ``json_lines``; of every thousand events, some are written in an odd way, one each."""
    plain = json_lines(events)
    patterns = F.array(*[F.lit(pattern.replace("%s", field)) for field, pattern, _, _ in ODD_LINES])
    others = F.array(*[F.lit(new.replace("%s", field)) for field, _, new, _ in ODD_LINES])
    case = (F.col("row_id") % 1000 - FIRST_ODD).cast("int")
    odd = F.regexp_replace("value", F.get(patterns, case), F.get(others, case))
    return plain.withColumn("value", F.when(case.between(0, len(ODD_LINES) - 1), odd).otherwise(F.col("value")))


def _columns(fields: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in fields.items()]


def _record(fields: dict[str, Column]) -> Column:
    return F.struct(*_columns(fields))


def _as_raw(events: DataFrame, number: Column, line: Column) -> DataFrame:
    return events.select(
        F.lit("telemetry/events.jsonl").alias("object_key"),
        F.lit(0).cast("bigint").alias("block_start"),
        number.alias("row_id"),
        line.alias("value"),
    )
