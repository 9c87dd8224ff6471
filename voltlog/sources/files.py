"""Finding new JSON-lines files and reading their lines."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import md5

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlog.sources import hadoop
from voltlog.sources.listing import files_below
from voltlog.sources.stores import Store, store_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: ``etag`` is that of the store, null where it has none; see ``with_etags``.
LISTING = T.StructType(
    [
        T.StructField("bucket_name", T.StringType()),
        T.StructField("object_key", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("etag", T.StringType()),
    ]
)
LINES = "object_key string, block_start bigint, row_id bigint, value string"
#: Bytes of a file that are hashed as one part.
PART = 64 << 20
#: Bytes read from a store at a time.
CHUNK = 1 << 20
#: Files that one scan is given by name.
FILES_OF_A_SCAN = 10_000


@dataclass(frozen=True)
class Source:
    """A bucket or folder and the prefix below it that holds the raw files.

    ``store`` may name a class (``module:Class``, see ``stores``) that lists and reads the files.
    """

    root: str
    prefix: str = "telemetry/"
    suffix: str = ".jsonl"
    store: str = ""

    @property
    def folder(self) -> str:
        return f"{self.root.rstrip('/')}/{self.prefix.rstrip('/')}".rstrip("/")


def list_files(spark: SparkSession, source: Source) -> DataFrame:
    """All candidate files with size and the store's etag, also empty ones and hidden names.

    Tasks list the folders; no content is read, and no name comes to the driver. Folder names such as
    ``hour=08`` mean nothing. Where a store cannot be listed, ``run_batch`` takes an inventory table instead.
    """
    root = hadoop.qualified(spark, source.root).rstrip("/")
    found = files_below(spark, hadoop.qualified(spark, source.folder), source.suffix, source.store)
    return found.select(
        F.lit(source.root).alias("bucket_name"), _key_of(root, F.col("path")).alias("object_key"), "path", "length", "etag"
    )


def _key_of(root: str, path: Column) -> Column:
    return F.substr(path, F.lit(len(root) + 2))


def candidate_report(spark: SparkSession, source: Source) -> DataFrame:
    """The files a run would look at; fails if there are none."""
    files = list_files(spark, source).select("bucket_name", "object_key", "length").orderBy("object_key")
    if files.isEmpty():
        raise FileNotFoundError(f"no *{source.suffix} files below {source.folder}")
    return files


def new_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose key and fingerprint are not in the ledger; the bucket does not count."""
    return files.join(ledger, ["object_key", "etag"], "left_anti")


def with_etags(spark: SparkSession, source: Source, candidates: DataFrame) -> DataFrame:
    """The files with an etag each: the store's, or a hash of the content where the store has none.

    That hash is made as object stores do it for uploads in parts: the hash of the hashes of all parts of
    ``PART`` bytes, and their number. Parts are dealt out to tasks, so a file of any size is hashed side by side.
    ``candidates`` must be a written table.
    """
    without = candidates.where("etag IS NULL")
    parts_of = F.ceil(F.col("length") / PART)
    many = without.agg(F.sum(parts_of)).first()[0] or 0
    if not many:
        return _named(candidates, F.coalesce("etag", F.lit(_empty())))
    tasks = min(int(many), max(4 * spark.sparkContext.defaultParallelism, int(many) // 8))
    parts = without.where("length > 0").select(
        "object_key", "path", F.explode(F.sequence(F.lit(0), parts_of - 1)).alias("part")
    ).repartition(tasks, "object_key", "part")
    named = source.store

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores: dict[str, Store] = {}
        for batch in batches:
            made = []
            for path, part in zip(batch["path"].to_pylist(), batch["part"].to_pylist(), strict=True):
                digest = md5(usedforsecurity=False)
                for chunk in _chunks(_store(stores, path, named), path, part * PART, PART):
                    digest.update(chunk)
                made.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["object_key"], batch["part"], pa.array(made, pa.string())], names=["object_key", "part", "digest"]
            )

    hashed = parts.mapInArrow(digests, "object_key string, part bigint, digest string")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("part", "digest"))), lambda p: p["digest"])
    own = hashed.groupBy("object_key").agg(
        F.concat(F.md5(F.concat_ws("", in_order).cast("binary")), F.lit("-"), F.count(F.lit(1)).cast("string")).alias("own")
    )
    return _named(candidates.join(own, "object_key", "left"), F.coalesce("etag", "own", F.lit(_empty())))


def _empty() -> str:
    return md5(usedforsecurity=False).hexdigest() + "-0"


def _named(files: DataFrame, etag: Column) -> DataFrame:
    return files.select(*[c for c in LISTING.names if c != "etag"], etag.alias("etag"))


def _store(stores: dict[str, Store], path: str, named: str) -> Store:
    """A task's client for the store of a path; made once for all paths of a bucket."""
    bucket = "/".join(path.split("/", 3)[:3])
    if bucket not in stores:
        stores[bucket] = store_of(path, named)
    return stores[bucket]


def _chunks(store: Store, path: str, start: int, length: int) -> Iterator[bytes]:
    end = start + length
    while start < end and (chunk := store.read(path, start, min(CHUNK, end - start))):
        yield chunk
        start += len(chunk)


def read_lines(spark: SparkSession, source: Source, files: DataFrame) -> DataFrame:
    """Every line of the files with its position, blank lines included; no other file is opened.

    Any later shuffle or filter leaves the positions as they are, so they can serve as order of the
    records: files by key, lines as in the file. Names of the files to read come to the driver, as Spark's own
    file index holds them; a scan gets a bounded number of them. Files with hidden names, which Spark's
    readers pass over, are read by tasks from the store. ``files`` is a written table.
    """
    root = hadoop.qualified(spark, source.root).rstrip("/")
    full = files.where("length > 0").select("path", _is_hidden(F.col("object_key")).alias("hidden"))
    paths, hidden = [], False
    for row in full.toLocalIterator():
        hidden |= row["hidden"]
        paths += [] if row["hidden"] else [row["path"]]
    scans = [
        spark.read.text([hadoop.escaped(p) for p in paths[i : i + FILES_OF_A_SCAN]]).select(
            _key_of(root, _decoded(F.col("_metadata.file_path"))).alias("object_key"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("row_id"),
            "value",
        )
        for i in range(0, len(paths), FILES_OF_A_SCAN)
    ]
    if hidden:
        scans.append(_lines_of_hidden(files.where(F.col("length") > 0).where(_is_hidden(F.col("object_key"))), source.store))
    return reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], LINES)


def _is_hidden(key: Column) -> Column:
    """Whether Spark's readers pass over a file because of its name, or that of a folder it lies in."""
    return key.rlike("(^|/)[._]")


def _lines_of_hidden(files: DataFrame, named: str) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores: dict[str, Store] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                for line in split_lines(_chunks(_store(stores, row["path"], named), row["path"], 0, row["length"])):
                    held.append(line)
                    size += len(line)
                    if size > 8 * CHUNK or len(held) == 10_000:
                        yield _of_file(row["object_key"], held)
                        held, size = [], 0
                yield _of_file(row["object_key"], held)

    tasks = files.sparkSession.sparkContext.defaultParallelism
    lines = files.repartition(tasks, "path").select("object_key", "path", "length").mapInArrow(
        read, "object_key string, value binary"
    )
    return lines.select(
        "object_key", F.lit(0).cast("bigint").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"), F.col("value").cast("string").alias("value"),
    )


def _of_file(key: str, lines: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([key] * len(lines), pa.string()), pa.array(lines, pa.binary())], names=["object_key", "value"]
    )


def split_lines(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """Lines as Spark's reader has them: any of the three line ends, no byte-order mark at the start."""
    rest, begun = b"", False
    for chunk in chunks:
        rest += chunk
        if not begun and len(rest) >= 3:
            rest, begun = rest.removeprefix(b"\xef\xbb\xbf"), True
        *lines, rest = rest.splitlines(keepends=True) or [b""]
        # the last one may go on in the next chunk, also between the two characters of a line end
        yield from (line.rstrip(b"\r\n") for line in lines)
    if rest:
        yield rest.rstrip(b"\r\n")


def _decoded(uri: Column) -> Column:
    # url_decode would also turn a plus sign into a space. The scheme loses its empty
    # authority on the way: file:///x and file:/x are the same path.
    plain = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^([a-z]+):///", "$1:/")
