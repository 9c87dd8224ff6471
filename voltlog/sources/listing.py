"""A listing of files as a Spark data source: tasks list folders, names never pass through the driver."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from voltlog.sources.stores import Entry, Store, store_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "voltlog_files"
SCHEMA = "path string, length bigint, modified timestamp, etag string"
#: Folders are looked for, level by level, until so many groups of them can be listed side by side.
GROUPS = 64
#: Files of a batch of rows.
BATCH = 10_000


@dataclass
class Folders(InputPartition):
    """Folders to list: those in ``whole`` with all that lies below, those in ``flat`` without."""

    whole: tuple[str, ...]
    flat: tuple[str, ...]


def walk(store: Store, folder: str) -> Iterator[Entry]:
    """All files below a folder."""
    todo = [folder]
    while todo:
        for entry in store.children(todo.pop()):
            if entry.is_folder:
                todo.append(entry.path)
            else:
                yield entry


class FileListing(DataSource):
    """Options: ``path``, the folder; ``suffix`` of the names that count; ``store``, ``groups``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FileListingReader:
        return FileListingReader(self.options)


class FileListingReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"].rstrip("/")
        self.suffix = options.get("suffix", "")
        self.named = options.get("store", "")
        self.groups = int(options.get("groups", GROUPS))

    def partitions(self) -> list[Folders]:
        """Only folders are looked for here, and no deeper than it takes to have enough of them."""
        store = store_of(self.folder, self.named)
        level, flat = [self.folder], []
        while level and len(level) < self.groups:
            below = [e.path for f in level for e in store.children(f) if e.is_folder]
            if not below:
                break
            flat += level
            level = below
        parts = min(self.groups, len(level) + len(flat))
        return [Folders(tuple(level[i::parts]), tuple(flat[i::parts])) for i in range(parts)]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        store = store_of(self.folder, self.named)

        def found() -> Iterator[Entry]:
            for folder in partition.flat:
                yield from (e for e in store.children(folder) if not e.is_folder)
            for folder in partition.whole:
                yield from walk(store, folder)

        rows: list[Entry] = []
        for entry in found():
            if entry.path.rsplit("/", 1)[-1].endswith(self.suffix):
                rows.append(entry)
            if len(rows) == BATCH:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[Entry]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([e.path for e in rows], pa.string()),
            pa.array([e.length for e in rows], pa.int64()),
            pa.array([int(e.modified * 1_000_000) for e in rows], pa.timestamp("us", tz="UTC")),
            pa.array([e.etag for e in rows], pa.string()),
        ],
        names=["path", "length", "modified", "etag"],
    )


def files_below(spark: SparkSession, folder: str, suffix: str, store: str = "") -> DataFrame:
    """``path``, ``length``, ``modified`` and the store's ``etag`` of all files with the suffix."""
    spark.dataSource.register(FileListing)
    reader = spark.read.format(FORMAT).option("suffix", suffix)
    if store:
        reader = reader.option("store", store)
    return reader.load(folder)
