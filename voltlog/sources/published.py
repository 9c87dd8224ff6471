"""The warehouse's folders as tables of Spark's catalog, so that SQL finds them by name."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from voltlog.schemas import LEDGER, TABLES
from voltlog.sources import hadoop


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(fields: list[T.StructField]) -> str:
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields)


def publish(spark: SparkSession, house: str, database: str, ledger: str) -> None:
    """Make the tables that are missing, and name the days that have come since; no row is read.

    The five tables, a staging table like each of them, and the ledger. A table has the column it is
    partitioned by last, which for hourly metrics is one more than its rows have. The catalog gets
    the days that it does not have yet; the folders of a table, one per day, are listed for that.
    """
    home = _quoted(database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {home}")
    for name, spec in TABLES.items():
        table, folder = f"{home}.{_quoted(name)}", f"{house}/curated/{name}"
        day = T.StructField(spec.day_column, T.DateType())
        fields = [f for f in spec.schema.fields if f.name != day.name]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({_columns([*fields, day])}) USING parquet "
            f"PARTITIONED BY ({_quoted(day.name)}) LOCATION {_text(folder)}"
        )
        spark.sql(f"CREATE TABLE IF NOT EXISTS {home}.{_quoted(name + '_staging')} LIKE {table} USING parquet")
        known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        new = sorted(n for n in hadoop.names_in(spark, folder) if n.startswith(day.name + "=") and n not in known)
        if new:
            days = " ".join(f"PARTITION ({_quoted(day.name)} = DATE{_text(n.split('=', 1)[1])})" for n in new)
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {days}")
        spark.sql(f"REFRESH TABLE {table}")
    table = f"{home}.processed_files"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_columns(LEDGER.fields)}) USING parquet LOCATION {_text(ledger)}")
    spark.sql(f"REFRESH TABLE {table}")
