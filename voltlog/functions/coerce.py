"""Lenient type coercion of one JSON value.

The rules are SQL text: each is the body of a ``transform`` over the fields of one kind,
where ``x`` has ``value`` (VARIANT, NULL when the key is absent), its ``kind`` as
``schema_of_variant`` names it, its ``text``, and the limits ``low``, ``high`` (NULL for
none) and ``required`` of the field. A rule gives the typed value and an error text, which
is NULL exactly when the value is acceptable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: accepted spellings and error sentences ---------------------
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")

MISSING = "Field required"
NOT_TEXT = "Input should be a valid string"
HALF_PAIR = "Input should be a valid string, unable to parse raw data as a unicode string"
TOO_SHORT = "String should have at least %d characters"
TOO_LONG = "String should have at most %d characters"
VIN_SPACE = "Value error, VIN cannot contain spaces"
NOT_NUMBER = "Input should be a valid number"
UNPARSED_NUMBER = "Input should be a valid number, unable to parse string as a number"
TOO_LOW = "Input should be greater than or equal to %d"
TOO_HIGH = "Input should be less than or equal to %d"
NOT_FLAG = "Input should be a valid boolean"
UNPARSED_FLAG = "Input should be a valid boolean, unable to interpret input"
NOT_INSTANT = "Input should be a valid datetime"
NO_ZONE = "Input should have timezone info"
UNKNOWN_FIELD = "Extra inputs are not permitted"

# Unix numbers above this size are milliseconds, otherwise seconds.
UNIX_MILLIS_ABOVE = 20_000_000_000
# First and last microsecond of the years 1 to 9999.
FIRST_MICRO = -62_135_596_800_000_000
LAST_MICRO = 253_402_300_799_999_999
# --- end of fixed values ------------------------------------------------------

# Characters removed by a text strip, and those trimmed around a number.
_WIDE_BLANKS = r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANKS = rf"[\x09-\x0d\x1c-\x20{_WIDE_BLANKS}]"
_NUMBER_BLANKS = rf"[\x09-\x0d\x20{_WIDE_BLANKS}]"

# All patterns end in \z, as $ would let a final line break pass.
_DECIMAL_TEXT = r"(?i)^[+-]?(inf|infinity|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?)\z"
_NAN_TEXT = r"(?i)^[+-]?nan\z"
_UNIX_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\z"
# Zoned times that Spark's own cast reads the same way; year 0 is none of them.
PLAIN_INSTANT = (
    r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?"
    r"(Z|[+-](0[0-9]|1[0-7]):[0-5][0-9])\z"
)
# Text that a strip leaves as it is and that upper-casing keeps as long as it is.
PLAIN_VIN = r"^[0-9A-Za-z]*\z"
_DATE = r"([0-9]{4}-[0-9]{2}-[0-9]{2})"
_CLOCK = r"[Tt _]((?:[01][0-9]|2[0-3]):[0-5][0-9])(?::([0-5][0-9])(?:[.,]([0-9]+))?)?"
# The real minus sign U+2212 is as good as a hyphen.
_ZONE = r"(?:[Zz]|([+\u2212-])([01][0-9]|2[0-3]):?([0-5][0-9]))"
_ZONED = rf"^(?!0000){_DATE}{_CLOCK}{_ZONE}\z"
_NAIVE = rf"^{_DATE}(?:{_CLOCK})?\z"


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(text, rf"^{BLANKS}+|{BLANKS}+\z", "")


def is_blank(text: Column) -> Column:
    # Nearly every line starts with a brace, which settles it without the pattern.
    return ~text.startswith("{") & text.rlike(rf"^{BLANKS}*\z")


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _one_of(words: tuple[str, ...]) -> str:
    return "(" + ", ".join(map(quoted, words)) + ")"


_IS_NUMBER = "(x.kind IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith(x.kind, 'DECIMAL'))"

_TEXT_ERROR = f"""CASE
  WHEN NOT x.required AND coalesce(x.kind = 'VOID', true) THEN NULL
  WHEN x.kind IS NULL THEN {quoted(MISSING)}
  WHEN x.kind <> 'STRING' THEN {quoted(NOT_TEXT)}
  WHEN char_length(x.text) < x.low THEN format_string({quoted(TOO_SHORT)}, x.low)
  WHEN char_length(x.text) > x.high THEN format_string({quoted(TOO_LONG)}, x.high)
END"""

TEXT = ("CASE WHEN x.kind = 'STRING' THEN x.text END", _TEXT_ERROR)

# Lengths are those of the raw text; the result is stripped and upper-cased.
_STRIPPED = f"""upper(regexp_replace(x.text, {quoted(rf'^{BLANKS}+|{BLANKS}+\z')}, ''))"""
VIN = (
    f"CASE WHEN x.kind = 'STRING' THEN {_STRIPPED} END",
    f"coalesce({_TEXT_ERROR}, CASE WHEN contains({_STRIPPED}, ' ') THEN {quoted(VIN_SPACE)} END)",
)


def word(allowed: tuple[str, ...]) -> tuple[str, str]:
    spelled = ", ".join(f"'{w}'" for w in allowed[:-1]) + f" or '{allowed[-1]}'"
    return (
        "CASE WHEN x.kind = 'STRING' THEN x.text END",
        f"""CASE
  WHEN x.kind IS NULL THEN {quoted(MISSING)}
  WHEN x.kind = 'STRING' AND x.text IN {_one_of(allowed)} THEN NULL
  ELSE {quoted(f'Input should be {spelled}')}
END""",
    )


# Decimal text may be surrounded by blanks, or have single underscores inside, not both.
_NUMBER_TEXT = f"""CASE
  WHEN NOT contains(x.text, '_')
    THEN regexp_replace(x.text, {quoted(rf'^{_NUMBER_BLANKS}+|{_NUMBER_BLANKS}+\z')}, '')
  WHEN NOT (startswith(x.text, '_') OR endswith(x.text, '_') OR contains(x.text, '__'))
    THEN replace(x.text, '_', '')
END"""
_NUMBER = f"""CASE
  WHEN {_IS_NUMBER} THEN try_variant_get(x.value, '$', 'double')
  WHEN x.kind = 'BOOLEAN' THEN CASE WHEN x.text = 'true' THEN 1D ELSE 0D END
  WHEN x.kind = 'STRING' THEN CASE
    WHEN ({_NUMBER_TEXT}) RLIKE {quoted(_DECIMAL_TEXT)} THEN try_cast(({_NUMBER_TEXT}) AS double)
    WHEN ({_NUMBER_TEXT}) RLIKE {quoted(_NAN_TEXT)} THEN double('NaN') END
END"""


def _unix(amount: str) -> str:
    """Instant of a number of seconds or milliseconds, to the microsecond."""
    scale = f"CASE WHEN abs({amount}) > {UNIX_MILLIS_ABOVE} THEN 1000 ELSE 1000000 END"
    micros = f"round(try_multiply(try_cast({amount} AS decimal(28,9)), cast({scale} AS decimal(7,0))), 0)"
    return f"""CASE WHEN {micros} BETWEEN {FIRST_MICRO} AND {LAST_MICRO}
  THEN timestamp_micros(try_cast({micros} AS bigint)) END"""


def _part(i: int) -> str:
    return f"regexp_extract(x.text, {quoted(_ZONED)}, {i})"


# The clock is read as UTC and the offset taken off, as Spark itself stops at 18 hours.
_LOCAL = f"""try_cast(concat({_part(1)}, 'T', {_part(2)}, ':',
  CASE WHEN {_part(3)} = '' THEN '00' ELSE {_part(3)} END, '.',
  rpad(substring({_part(4)}, 1, 6), 6, '0'), 'Z') AS timestamp)"""
_AHEAD = f"""CASE {_part(5)} WHEN '' THEN 0 WHEN '+' THEN 1 ELSE -1 END
  * (coalesce(try_cast({_part(6)} AS bigint), 0) * 3600 + coalesce(try_cast({_part(7)} AS bigint), 0) * 60)"""
_INSTANT = f"""CASE
  WHEN x.kind = 'STRING' THEN CASE
    WHEN x.text RLIKE {quoted(PLAIN_INSTANT)} THEN try_cast(x.text AS timestamp)
    WHEN x.text RLIKE {quoted(_ZONED)}
      THEN timestamp_micros(unix_micros({_LOCAL}) - ({_AHEAD}) * 1000000)
    WHEN x.text RLIKE {quoted(_UNIX_TEXT)} THEN {_unix('try_cast(x.text AS decimal(38,9))')} END
  WHEN {_IS_NUMBER} THEN {_unix("try_variant_get(x.value, '$', 'decimal(38,9)')")}
END"""

_AMOUNT = f"CASE WHEN {_IS_NUMBER} THEN try_variant_get(x.value, '$', 'double') END"
_FLAG = f"""CASE
  WHEN x.kind = 'BOOLEAN' THEN x.text = 'true'
  WHEN x.kind = 'STRING' AND lower(x.text) IN {_one_of(TRUE_WORDS)} THEN true
  WHEN x.kind = 'STRING' AND lower(x.text) IN {_one_of(FALSE_WORDS)} THEN false
  WHEN ({_AMOUNT}) = 1 THEN true
  WHEN ({_AMOUNT}) = 0 THEN false
END"""

# Errors of these three kinds look at the typed value, which they see as x.typed.
NUMBER = (
    _NUMBER,
    f"""CASE
  WHEN x.kind IS NULL THEN {quoted(MISSING)}
  WHEN x.typed IS NULL AND x.kind = 'STRING' THEN {quoted(UNPARSED_NUMBER)}
  WHEN x.typed IS NULL THEN {quoted(NOT_NUMBER)}
  WHEN x.typed > x.high THEN format_string({quoted(TOO_HIGH)}, x.high)
  WHEN x.typed < x.low OR (isnan(x.typed) AND x.low IS NOT NULL)
    THEN format_string({quoted(TOO_LOW)}, x.low)
END""",
)
INSTANT = (
    _INSTANT,
    f"""CASE
  WHEN x.kind IS NULL THEN {quoted(MISSING)}
  WHEN x.typed IS NOT NULL THEN NULL
  WHEN x.kind = 'STRING' AND x.text RLIKE {quoted(_NAIVE)}
    AND try_cast(substring(x.text, 1, 10) AS date) IS NOT NULL THEN {quoted(NO_ZONE)}
  ELSE {quoted(NOT_INSTANT)}
END""",
)
FLAG = (
    _FLAG,
    f"""CASE
  WHEN x.kind IS NULL THEN {quoted(MISSING)}
  WHEN x.typed IS NOT NULL THEN NULL
  WHEN x.kind = 'STRING' THEN {quoted(UNPARSED_FLAG)}
  WHEN ({_AMOUNT}) = rint({_AMOUNT}) AND abs({_AMOUNT}) < double('9223372036854775808')
    THEN {quoted(UNPARSED_FLAG)}
  ELSE {quoted(NOT_FLAG)}
END""",
)
