"""File stores as the tasks of a job see them: listing of one folder, and reading a part of one file.

Spark's readers pass over hidden names and do not tell a store's etags; tasks therefore list and read
through these few calls. Which store serves a path is found by its scheme; a source may name its own.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from importlib import import_module
from typing import Protocol
from urllib.parse import urlsplit

from pyspark import cloudpickle

# Classes travel to the executors whole, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class NoStore(ValueError):
    """No store is known that can list a path; pass a listing to the run instead."""


@dataclass(frozen=True)
class Entry:
    """A file or folder. ``etag`` is None where the store has none; ``modified`` is in seconds since 1970."""

    path: str
    is_folder: bool
    length: int = 0
    modified: float = 0.0
    etag: str | None = None


class Store(Protocol):
    def children(self, folder: str) -> Iterator[Entry]:
        """What lies directly in a folder, hidden names included; nothing if there is no such folder."""

    def read(self, path: str, start: int, length: int) -> bytes:
        """At most so many bytes of a file."""


class LocalStore:
    """Disks mounted at the same place everywhere (``file:``); such files have no etags."""

    def children(self, folder: str) -> Iterator[Entry]:
        try:
            found = os.scandir(self._plain(folder))
        except (FileNotFoundError, NotADirectoryError):
            return
        with found:
            for e in found:
                path = f"{folder}/{e.name}"
                if e.is_dir():
                    yield Entry(path, True)
                # a writer may take a file away between the listing and the look at it
                elif e.is_file():
                    stat = e.stat()
                    yield Entry(path, False, stat.st_size, stat.st_mtime)

    def read(self, path: str, start: int, length: int) -> bytes:
        with open(self._plain(path), "rb") as f:
            f.seek(start)
            return f.read(length)

    @staticmethod
    def _plain(path: str) -> str:
        return path.removeprefix("file:") if path.startswith("file:/") else path


class S3Store:
    """Buckets of an object store with the S3 interface, through boto3 where that is installed."""

    def __init__(self, client=None):
        if client is None:
            import boto3

            client = boto3.client("s3")
        self.client = client

    def children(self, folder: str) -> Iterator[Entry]:
        root, bucket, prefix = self._parts(folder + "/")
        for page in self.client.get_paginator("list_objects_v2").paginate(Bucket=bucket, Prefix=prefix, Delimiter="/"):
            for sub in page.get("CommonPrefixes", ()):
                yield Entry(root + sub["Prefix"].rstrip("/"), True)
            for o in page.get("Contents", ()):
                if o["Key"] != prefix:  # a marker of the folder itself
                    yield Entry(root + o["Key"], False, o["Size"], o["LastModified"].timestamp(), o["ETag"].strip('"'))

    def read(self, path: str, start: int, length: int) -> bytes:
        _, bucket, key = self._parts(path)
        wanted = f"bytes={start}-{start + length - 1}"
        return self.client.get_object(Bucket=bucket, Key=key, Range=wanted)["Body"].read()

    @staticmethod
    def _parts(path: str) -> tuple[str, str, str]:
        scheme, rest = path.split("://", 1)
        bucket, key = rest.split("/", 1)
        return f"{scheme}://{bucket}/", bucket, key


class ArrowStore:
    """Stores that Arrow has a client for, such as HDFS or Google's buckets; it does not tell etags."""

    def __init__(self, uri: str):
        from pyarrow import fs

        self.fs, _ = fs.FileSystem.from_uri(uri)
        parts = urlsplit(uri)
        # a bucket is part of the client's paths, the name of a file system's host is not
        self.root = f"{parts.scheme}://" + (parts.netloc if parts.scheme in ("hdfs", "viewfs") else "")

    def children(self, folder: str) -> Iterator[Entry]:
        from pyarrow import fs

        selector = fs.FileSelector(folder.removeprefix(self.root), allow_not_found=True)
        for info in self.fs.get_file_info(selector):
            is_folder = info.type == fs.FileType.Directory
            modified = info.mtime.timestamp() if info.mtime else 0.0
            yield Entry(self.root + info.path, is_folder, info.size or 0, modified)

    def read(self, path: str, start: int, length: int) -> bytes:
        with self.fs.open_input_file(path.removeprefix(self.root)) as f:
            return f.read_at(length, start)


def store_of(uri: str, named: str = "") -> Store:
    """The store for a path. ``named`` is a class as ``module:Class``, for stores that are not known here."""
    if named:
        module, _, name = named.partition(":")
        return getattr(import_module(module), name)()
    scheme = urlsplit(uri).scheme
    if scheme in ("", "file"):
        return LocalStore()
    if scheme in ("s3", "s3a", "s3n"):
        try:
            return S3Store()
        except ImportError:
            return ArrowStore("s3://" + uri.split("://", 1)[1])
    try:
        return ArrowStore(uri)
    except Exception as error:
        raise NoStore(f"cannot list {uri}: {error}") from error
