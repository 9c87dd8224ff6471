"""Schema and plausibility checks of a batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlog.functions import coerce
from voltlog.operators.lines import members_sql
from voltlog.operators.merge import joined_by_number
from voltlog.schemas import EVENT, EVENT_TYPES, FIELD_NAMES, FIELDS, POSITION, Field
from voltlog.session import scratch_folder

# --- fixed values: sentences of the batch rules, in reporting order ------------
DUPLICATE = "duplicate event_id in this batch"
TOO_EARLY = "event_ts is later than ingest_ts"
NO_ODOMETER = "speed is above 0 but odometer is 0"
NO_ALERT_CODE = "alert event has no alert_code"
SCHEMA_PROBLEM = "%s: field '%s' is wrong: %s"
# --- end of fixed values ------------------------------------------------------

# How a value of each kind looks in a line that needs no second look: the natural JSON type,
# and text without escapes. Quantifiers are possessive, so a match is one pass.
_TEXT_TOKEN = r'"[^"\\\x00-\x1f]*+"'
_PLAIN_TOKEN = {
    "text": _TEXT_TOKEN,
    "vin": _TEXT_TOKEN,
    "word": _TEXT_TOKEN,
    "instant": _TEXT_TOKEN,
    "number": r"-?+(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?+[0-9]++)?+",
    "flag": "(?:true|false)",
}
_RULES = {
    "text": coerce.TEXT,
    "vin": coerce.VIN,
    "word": coerce.word(EVENT_TYPES),
    "instant": coerce.INSTANT,
    "number": coerce.NUMBER,
    "flag": coerce.FLAG,
}
_UNREAD = T.StructType(
    [T.StructField(f.name, T.StringType() if f.kind == "instant" else EVENT[f.name].dataType) for f in FIELDS]
)


def check_schema(raw: DataFrame) -> DataFrame:
    """One row per line: typed fields plus ``broken``, ``raw_id``, ``error_field``, ``error_text``.

    The error is that of the first wrong field in contract order; fields outside the
    contract come last, in the order in which the line has them.

    Lines that hold known fields of natural type within the limits, which is nearly all of
    them, are read directly. All others, wrong or only unusually written, go through
    ``_examine_sql``, which alone knows every rule.
    """
    # The partition number is never negative. Naming it keeps the optimizer from copying the
    # expressions below into every filter that a caller puts on the result.
    once = F.spark_partition_id() >= 0
    direct = F.from_json("value", _UNREAD)
    plain = once & F.is_valid_utf8("value") & F.col("value").rlike(_plain_line())
    read = raw.select(*POSITION, "value", F.when(plain, direct).alias("read"))
    typed = read.selectExpr(*POSITION, "value", *map(_read_sql, FIELDS))
    odd = once & ~_is_plain()
    examined = typed.select("*", F.when(odd, F.expr(_examine_sql())).alias("examined"))
    return examined.selectExpr(
        *POSITION,
        "coalesce(examined.broken, false) AS broken",
        "CASE WHEN examined.error IS NOT NULL THEN examined.raw_id END AS raw_id",
        "examined.error.name AS error_field",
        "examined.error.error AS error_text",
        *[f"CASE WHEN examined IS NULL THEN {_plain_sql(f)} ELSE {_examined_sql(f)} END AS {f.name}" for f in FIELDS],
    )


def _of_kind(kind: str) -> list[Field]:
    return [f for f in FIELDS if f.kind == kind]


def _read_sql(f: Field) -> str:
    if f.kind != "instant":
        return f"read.{f.name} AS {f.name}"
    plain = f"read.{f.name} RLIKE {coerce.quoted(coerce.PLAIN_INSTANT)}"
    return f"CASE WHEN {plain} THEN try_cast(read.{f.name} AS timestamp) END AS {f.name}"


def _plain_sql(f: Field) -> str:
    return f"upper({f.name})" if f.kind == "vin" else f.name


def _examined_sql(f: Field) -> str:
    return f"examined.{f.kind}[{_of_kind(f.kind).index(f)}].typed"


def _plain_line() -> str:
    """One JSON object with nothing around it, made of known fields of natural type.

    Says nothing about which fields are there, or how often: as with any JSON reader here,
    the last of several values counts, and all of them have the same type.
    """
    members = []
    for kind, token in _PLAIN_TOKEN.items():
        names = "|".join(f.name for f in _of_kind(kind) if f.required)
        members.append(rf'"(?:{names})"\s*+:\s*+{token}')
    for f in FIELDS:
        if not f.required:
            members.append(rf'"{f.name}"\s*+:\s*+(?:null|{_PLAIN_TOKEN[f.kind]})')
    member = f"(?:{'|'.join(members)})"
    return rf"^\{{\s*+{member}(?:\s*+,\s*+{member})*+\s*+\}}\z"


def _is_plain() -> Column:
    """All required fields were read directly and are within the limits."""
    words = ", ".join(map(coerce.quoted, EVENT_TYPES))
    rules = [f"vin RLIKE {coerce.quoted(coerce.PLAIN_VIN)}", f"event_type IN ({words})"]
    for f in FIELDS:
        if f.required:
            rules.append(f"{f.name} IS NOT NULL")
        measure = f"char_length({f.name})" if f.kind in ("text", "vin") else f.name
        if f.low is not None:
            rules.append(f"{measure} >= {f.low}")
        if f.high is not None:
            rules.append(f"{measure} <= {f.high}")
    return F.expr(f"coalesce({' AND '.join(rules)}, false)")


def _examine_sql() -> str:
    """Typed values and errors of a line by the full rules, one array per kind of field.

    Each rule is stated once, as a function over the array of its fields; written out per
    field the expression would outgrow what the JVM compiles. The one-element arrays around
    it only give names to values that are used more than once.
    """
    results = ",\n".join(f"'{kind}', {_judged(kind)}" for kind in _RULES)
    errors = ", ".join(
        f"transform(r.{kind}, e -> named_struct('place', e.place, 'name', e.name, 'error', e.error))"
        for kind in _RULES
    )
    known = ", ".join(map(coerce.quoted, FIELD_NAMES))
    halved = f"regexp_extract(value, {coerce.quoted(_half_pair())}, 1)"
    errors += f""", CASE WHEN {halved} = '' THEN array() ELSE array(named_struct(
      'place', cast(array_position(array({known}), {halved}) AS int) - 1, 'name', {halved},
      'error', {coerce.quoted(coerce.HALF_PAIR)})) END"""
    unknown = f"array_except(json_object_keys(value), array({known}))"
    kinds = ", ".join(f"'{kind}', r.{kind}" for kind in _RULES)
    return f"""
transform(transform(array({members_sql("value")}), members -> named_struct(
  'broken', members IS NULL,
  'raw_id', {_written_id_sql()},
  {results}
)), r -> named_struct('broken', r.broken, 'raw_id', r.raw_id, {kinds},
  'error', CASE WHEN r.broken THEN NULL ELSE coalesce(
    array_min(filter(concat({errors}), e -> e.error IS NOT NULL)),
    CASE WHEN size({unknown}) > 0 THEN named_struct(
      'place', {len(FIELDS)}, 'name', get({unknown}, 0), 'error', {coerce.quoted(coerce.UNKNOWN_FIELD)}) END
  ) END))[0]"""


def _half_pair() -> str:
    """A text field with an escape for one half of a surrogate pair, which is no character."""
    names = "|".join(f.name for f in _of_kind("text") + _of_kind("vin"))
    high, low = r"\\u[dD][89abAB][0-9a-fA-F]{2}", r"\\u[dD][c-fC-F][0-9a-fA-F]{2}"
    other = rf'(?:[^"\\]|\\[^u]|\\u(?![dD][89a-fA-F])[0-9a-fA-F]{{4}}|{high}{low})'
    return rf'"({names})"\s*+:\s*+"{other}*+(?:{high}|{low})'


def _judged(kind: str) -> str:
    typed, error = _RULES[kind]
    fields = ", ".join(
        f"named_struct('place', {FIELDS.index(f)}, 'name', '{f.name}', 'value', members['{f.name}'], "
        f"'low', cast({_or_null(f.low)} AS int), 'high', cast({_or_null(f.high)} AS int), "
        f"'required', {str(f.required).lower()})"
        for f in _of_kind(kind)
    )
    given = ", ".join(f"'{c}', x.{c}" for c in ("place", "name", "value", "low", "high", "required"))
    kept = ", ".join(f"'{c}', x.{c}" for c in ("place", "name", "low", "high", "required", "kind", "text", "value"))
    return f"""transform(transform(transform(array({fields}),
  x -> named_struct({given}, 'kind', schema_of_variant(x.value), 'text', try_variant_get(x.value, '$', 'string'))),
  x -> named_struct({kept}, 'typed', {typed})),
  x -> named_struct('place', x.place, 'name', x.name, 'typed', x.typed, 'error', {error}))"""


def _or_null(limit: int | None) -> str:
    return "NULL" if limit is None else str(limit)


def _written_id_sql() -> str:
    """The id as the line has it, for the report on a line whose fields cannot be trusted."""
    text = "try_variant_get(members['event_id'], '$', 'string')"
    return f"""CASE coalesce(schema_of_variant(members['event_id']), '')
  WHEN '' THEN 'unknown' WHEN 'VOID' THEN 'None' WHEN 'BOOLEAN' THEN initcap({text}) ELSE {text} END"""


def valid_rows(checked: DataFrame) -> DataFrame:
    """Rows that meet the schema, whether or not a batch rule objects to them."""
    return checked.where(~F.col("broken") & F.col("error_text").isNull())


def clean_events(checked: DataFrame) -> DataFrame:
    return valid_rows(checked).select(*FIELD_NAMES)


def is_too_early() -> Column:
    return F.col("event_ts") > F.col("ingest_ts")


def has_no_odometer() -> Column:
    return (F.col("speed_mph") > 0) & (F.col("odometer_miles") == 0)


def has_no_alert_code() -> Column:
    return (F.col("event_type") == "alert") & (F.coalesce(F.col("alert_code"), F.lit("")) == "")


def schema_problems(checked: DataFrame) -> DataFrame:
    bad = checked.where(~F.col("broken") & F.col("error_text").isNotNull())
    return bad.select(
        *POSITION,
        F.lit(0).alias("rule_no"),
        F.format_string(SCHEMA_PROBLEM, "raw_id", "error_field", "error_text").alias("problem"),
    )


def row_problems(checked: DataFrame) -> DataFrame:
    """Rules that look at one row; several may fire for it."""
    rules = [(2, is_too_early(), TOO_EARLY), (3, has_no_odometer(), NO_ODOMETER),
             (4, has_no_alert_code(), NO_ALERT_CODE)]
    fired = F.array(
        *[F.when(rule, F.struct(F.lit(no).alias("rule_no"), F.lit(text).alias("text")))
          for no, rule, text in rules]
    )
    any_fired = reduce(lambda a, b: a | b, [rule for _, rule, _ in rules])
    return (
        valid_rows(checked)
        .where(any_fired)
        .select(*POSITION, "event_id", F.explode(F.array_compact(fired)).alias("rule"))
        .select(*POSITION, "rule.rule_no", F.concat_ws(": ", "event_id", "rule.text").alias("problem"))
    )


def repeated_ids(rows: DataFrame) -> DataFrame:
    """``event_id`` and number of ``occurrences``, for ids that occur twice or more.

    Nothing but ids crosses the shuffle, and the copies of one id only as a count per task.
    """
    return rows.groupBy("event_id").agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def later_duplicates(rows: DataFrame) -> DataFrame:
    """Every occurrence of an id after its first one, in listing order, with the file of the first.

    The first positions are one aggregate, to which an id brings one row per task however often it
    occurs; those of ids that occur again are written, as usually they are few. The rows then meet their first
    position in an inner join, to which few are sent; where they are many Spark can split an id with very many rows.
    """
    rows = rows.select(*POSITION, "event_id")
    position = F.struct(*POSITION)
    first = rows.groupBy("event_id").agg(
        F.min(position).alias("first_position"), F.count(F.lit(1)).alias("occurrences")
    ).where("occurrences > 1")
    folder = scratch_folder(rows.sparkSession)
    first.write.parquet(folder)
    first = joined_by_number(rows.sparkSession.read.schema(first.schema).parquet(folder))
    later = rows.join(first, "event_id").where(position > F.col("first_position"))
    return later.select(*POSITION, "event_id", F.col("first_position.object_key").alias("first_key"))


def duplicate_problems(checked: DataFrame) -> DataFrame:
    return later_duplicates(valid_rows(checked)).select(
        *POSITION,
        F.lit(1).alias("rule_no"),
        F.concat(F.col("event_id"), F.lit(": " + DUPLICATE)).alias("problem"),
    )


def problems(checked: DataFrame) -> DataFrame:
    """All problems of a batch; sort by position and ``rule_no`` for reporting order."""
    return (
        schema_problems(checked)
        .unionByName(duplicate_problems(checked))
        .unionByName(row_problems(checked))
    )


def check_records(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(clean events, problems)`` of raw lines.

    Both read the lines anew; write the result of ``check_schema`` first if there are many.
    """
    checked = check_schema(raw)
    return clean_events(checked), problems(checked)


def gate_counts(checked: DataFrame) -> DataFrame:
    """One row of counts that decides about the batch, from one narrow scan."""
    valid = ~F.col("broken") & F.col("error_text").isNull()
    return checked.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if("broken").alias("broken"),
        F.count_if(~F.col("broken") & F.col("error_text").isNotNull()).alias("schema"),
        F.count_if(valid & is_too_early()).alias("too_early"),
        F.count_if(valid & has_no_odometer()).alias("no_odometer"),
        F.count_if(valid & has_no_alert_code()).alias("no_alert_code"),
    )
