"""Report queries over the curated tables and the ledger."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def loaded_files(ledger: DataFrame) -> DataFrame:
    return ledger.select("object_key", "etag", "processed_at").orderBy("processed_at", "object_key")


def events_by_time(enriched: DataFrame) -> DataFrame:
    return enriched.orderBy("event_ts", "event_id")


def by_vehicle_and_time(enriched: DataFrame) -> DataFrame:
    return enriched.orderBy("vin", "event_ts")
