"""Curated tables: plain Parquet folders, one per day, changed by whole days.

A run may only be repeated after a crash, never run twice at the same time: every step can be
done again with the same result, and the ledger, which says that a file is loaded, is written last.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlog.operators.merge import joined_by_number, key_violations, upsert
from voltlog.schemas import TableSpec
from voltlog.sources import hadoop

Stage = Callable[[str, DataFrame], DataFrame]


class KeyViolation(ValueError):
    """The source of an upsert has a key twice, or a required column is empty."""


@dataclass(frozen=True)
class AppendTable:
    """A table to which rows are only added."""

    spark: SparkSession
    path: str
    schema: T.StructType

    def read(self) -> DataFrame:
        if not hadoop.exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        rows.select(*self.schema.names).write.mode("append").parquet(self.path)


def _of_folders(spark: SparkSession, path: str, column: str, values: list, schema: T.StructType) -> DataFrame:
    """Rows of the folders ``column=value`` that exist; the others of the table are not listed."""
    pattern = f"{hadoop.escaped(path)}/{column}={{{','.join(map(str, values))}}}"
    if not values or not hadoop.any_match(spark, pattern):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(pattern)


@dataclass(frozen=True)
class DayIndex:
    """The days at which each key of a table was ever stored, as a table in buckets by a hash of the key.

    A batch opens only the folders of the buckets that its keys fall into. Entries are added before the rows
    they are about and never taken out, so the index may name a day that a key has left, never too few days.
    """

    spark: SparkSession
    path: str
    key: str
    #: Part of the folders' layout: an index keeps the number it was begun with.
    buckets: int = 64

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    @property
    def exists(self) -> bool:
        return hadoop.exists(self.spark, self.path)

    def add(self, rows: DataFrame, day: str, mode: str = "append") -> None:
        entries = rows.select(self.key, F.expr(day).alias("day"), self._bucket().alias("bucket"))
        # a bucket is one file of a batch; the number of tasks is fixed so that few keys are written side by side too
        entries.repartition(self.buckets, "bucket").sortWithinPartitions("bucket", self.key).write.mode(mode).partitionBy(
            "bucket"
        ).parquet(self.path)

    def entries_of(self, keys: DataFrame) -> DataFrame:
        """Entries of the buckets of the keys: ``day`` and the key, other keys of the buckets included."""
        wanted = sorted(r[0] for r in keys.select(self._bucket()).distinct().collect())
        schema = T.StructType([T.StructField(self.key, T.StringType()), T.StructField("day", T.DateType())])
        return _of_folders(self.spark, self.path, "bucket", wanted, schema)

    def days_of(self, keys: DataFrame) -> set[dt.date]:
        """``keys`` is a written table; if it is small it is sent to the entries rather than shuffling those."""
        wanted = joined_by_number(keys.select(self.key))
        return distinct_days(self.entries_of(keys).join(wanted, self.key, "left_semi"), "day")

    def compact(self) -> None:
        """Write every entry once, in few files. Not while a run goes on."""
        if self.exists:
            schema = f"{self.key} string, day date, bucket int"
            kept = f"{self.path}.compact"
            self.spark.read.schema(schema).parquet(self.path).select(self.key, "day").distinct().write.mode(
                "overwrite"
            ).parquet(kept)
            self.add(self.spark.read.parquet(kept), "day", "overwrite")
            hadoop.delete(self.spark, kept)


@dataclass(frozen=True)
class CuratedTable:
    """A table with upsert by key, partitioned by day. ``index`` leads from keys without a day to their days."""

    spark: SparkSession
    path: str
    spec: TableSpec
    index: DayIndex | None = None

    @classmethod
    def open(cls, spark: SparkSession, warehouse: str, spec: TableSpec, folder: str = "curated") -> "CuratedTable":
        house = warehouse.rstrip("/")
        index = None if spec.day_in_key else DayIndex(spark, f"{house}/index/{spec.name}", spec.keys[0])
        return cls(spark, f"{house}/{folder}/{spec.name}", spec, index)

    @property
    def _schema(self) -> T.StructType:
        day = T.StructField(self.spec.day_column, T.DateType())
        return T.StructType([*[f for f in self.spec.schema.fields if f.name != day.name], day])

    @property
    def exists(self) -> bool:
        return hadoop.exists(self.spark, self.path)

    def read(self) -> DataFrame:
        if not self.exists:
            return self.spark.createDataFrame([], self.spec.schema)
        return self.spark.read.schema(self._schema).parquet(self.path).select(*self.spec.schema.names)

    def read_days(self, days: set[dt.date]) -> DataFrame:
        return self._of_days(days).select(*self.spec.schema.names)

    def _of_days(self, days: set[dt.date]) -> DataFrame:
        """Rows of some days with the day column, which is a folder name; other folders are not listed."""
        return _of_folders(self.spark, self.path, self.spec.day_column, sorted(days), self._schema)

    def replaced_rows(self, gone: DataFrame) -> DataFrame:
        """Stored rows, with the day column, whose key is among those of ``gone``, a written table.

        An event keeps its id when a correction moves it to another day; the index names the days
        at which such keys may be. Of those days, only the columns that are asked for are read.
        """
        keys = gone.select(*self.spec.keys)
        if not self.exists:
            return self._of_days(set())
        days = distinct_days(gone, self.spec.day) if self.spec.day_in_key else self.index.days_of(keys)
        return self._of_days(days).join(joined_by_number(keys), list(self.spec.keys), "left_semi")

    def prepare_index(self) -> None:
        """An index for a table that was filled without one."""
        if self.index and not self.index.exists and self.exists:
            self.index.add(self.read(), self.spec.day)

    def check_source(self, source: DataFrame) -> None:
        bad = key_violations(source, self.spec.keys, self.spec.required).count()
        if bad:
            raise KeyViolation(f"{self.spec.name}: {bad} duplicate or missing keys in the source")

    def upsert(self, source: DataFrame, stage: Stage, replaced: DataFrame | None = None,
               keys_checked: bool = False) -> None:
        """Put the rows of ``source`` in place of those with the same keys.

        Rows of days that lose nothing are appended; days that lose a row are written anew through
        staging, which ``stage`` writes and reads back. ``replaced`` names the keys that leave the
        table where those are not the keys of the source. Both must be written tables. After a crash in
        between, the same upsert completes the work.
        """
        if not keys_checked:
            self.check_source(source)
        spec, day = self.spec, self.spec.day_column
        gone = source if replaced is None else replaced
        changed = distinct_days(self.replaced_rows(gone), day) if self.exists else set()
        dated = source.withColumn(day, F.expr(spec.day))
        if self.index:
            self.index.add(source, spec.day)
        self._write(dated.where(~F.col(day).isin(sorted(changed))), "append")
        if changed:
            rows = upsert(
                self.read_days(changed), source.where(F.expr(spec.day).isin(sorted(changed))), spec.keys,
                joined_by_number(gone.select(*spec.keys)),
            )
            staged = stage(f"changed_days_of_{spec.name}", rows.withColumn(day, F.expr(spec.day)))
            # a day that loses its only rows must be written too, as an empty one
            for lost in sorted(changed - distinct_days(staged, day)):
                staged.limit(0).drop(day).write.mode("overwrite").parquet(f"{self.path}/{day}={lost}")
            self._write(staged, "overwrite")

    def _write(self, rows: DataFrame, mode: str) -> None:
        # The rebalance brings the rows of a day together but splits days that are large,
        # so neither many small files nor one very long task comes out.
        order = [c for c in ("vin", "event_ts", "event_hour") if c in self.spec.schema.names]
        day = self.spec.day_column
        (
            rows.hint("rebalance", day)
            .sortWithinPartitions(day, *order)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(day)
            .parquet(self.path)
        )


def distinct_days(rows: DataFrame, day: str) -> set[dt.date]:
    """Days that occur, as a local set: one entry per folder of the table at most."""
    return {r[0] for r in rows.select(F.expr(day).alias("day")).distinct().collect()}
