"""JSON lines to candidate events, and line numbers for error reports.

Raw lines have the columns ``object_key, block_start, row_id, value``: the file, the start
of its split, and an id that grows with the line inside a split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltlog.functions.coerce import is_blank
from voltlog.session import scratch_folder


def drop_blank(raw: DataFrame) -> DataFrame:
    return raw.where(~is_blank(F.col("value")))


def members_sql(line: str) -> str:
    """The line's JSON object as map of VARIANT, as SQL text; NULL for a broken line.

    A lenient JSON reader stops after the first value and ignores the rest of the line.
    The line is therefore parsed as first element of an array that ends with a hash of
    that very line: only if nothing else follows the value is the hash the second element.
    """
    token = f"xxhash64({line})"
    return f"""CASE WHEN is_valid_utf8({line}) THEN transform(
  array(try_parse_json(concat('[', {line}, ',', cast({token} AS string), ']'))),
  parsed -> CASE WHEN try_variant_get(parsed, '$[1]', 'bigint') = {token}
                 THEN try_variant_get(parsed, '$[0]', 'map<string,variant>') END)[0] END"""


def number_lines(raw: DataFrame) -> DataFrame:
    """Add ``line_no``, counted from 1 over all lines of a file, blank ones included.

    Needs every line of the files in ``raw``. The table of split offsets is written first: then
    Spark knows its size when it plans the join with the lines.
    """
    blocks = raw.groupBy("object_key", "block_start").agg(
        F.min("row_id").alias("first_id"), F.count(F.lit(1)).alias("line_count")
    )
    before = Window.partitionBy("object_key").orderBy("block_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = blocks.select(
        "object_key",
        "block_start",
        "first_id",
        F.coalesce(F.sum("line_count").over(before), F.lit(0)).alias("lines_before"),
    )
    folder = scratch_folder(raw.sparkSession)
    offsets.write.parquet(folder)
    offsets = raw.sparkSession.read.schema(offsets.schema).parquet(folder)
    return raw.join(offsets, ["object_key", "block_start"]).select(
        *raw.columns,
        (F.col("lines_before") + F.col("row_id") - F.col("first_id") + 1).alias("line_no"),
    )
