"""JSON-lines files of clean events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlog.functions.derive import iso_utc
from voltlog.schemas import EVENT, FIELD_NAMES


def to_lines(events: DataFrame) -> DataFrame:
    """One JSON object per event in contract order, with empty fields written as null."""
    columns = [
        iso_utc(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in EVENT.fields
    ]
    return events.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))


def write_json_lines(events: DataFrame, path: str) -> None:
    to_lines(events).write.mode("overwrite").text(path)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Events as written by ``write_json_lines``; anything else is an error."""
    return spark.read.schema(EVENT).option("mode", "FAILFAST").json(path).select(*FIELD_NAMES)
