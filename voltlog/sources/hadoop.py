"""The few calls to the Hadoop filesystem that Spark's readers and writers do not offer."""

from __future__ import annotations

import os

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme, as Spark reports it for files it reads."""
    fs, jpath = _path(spark, path)
    return fs.makeQualified(jpath).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _path(spark, path)
    return fs.exists(jpath)


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _path(spark, path)
    fs.delete(jpath, True)


def scheme(spark: SparkSession, path: str) -> str:
    fs, _ = _path(spark, path)
    return fs.getUri().getScheme()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a small folder; none if there is no such folder."""
    fs, jpath = _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 at which a file was last written."""
    fs, jpath = _path(spark, path)
    return fs.getFileStatus(jpath).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    """A small file; empty if there is none."""
    fs, jpath = _path(spark, path)
    if not fs.exists(jpath):
        return ""
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, jpath = _path(spark, path)
    stream = fs.create(jpath, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def create_exclusively(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file; False if there is one already, also if another process makes it right now."""
    fs, jpath = _path(spark, path)
    if fs.getUri().getScheme() == "file":  # Hadoop's local files are looked for first and then made
        plain = fs.makeQualified(jpath).toUri().getPath()
        os.makedirs(os.path.dirname(plain), exist_ok=True)
        try:
            with open(plain, "x") as f:
                f.write(text)
        except FileExistsError:
            return False
        return True
    try:
        stream = fs.create(jpath, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    return True


def escaped(path: str) -> str:
    """The path with the characters escaped that would be taken as wildcards."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def any_match(spark: SparkSession, pattern: str) -> bool:
    fs, jpath = _path(spark, pattern)
    found = fs.globStatus(jpath)
    return found is not None and len(found) > 0
