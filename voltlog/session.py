"""Session settings the jobs rely on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Counts of whole tables come from the footers of their files; see ``footers``.
    "spark.sql.parquet.aggregatePushdown": "true",
}


#: Files of a text table that a task writes side by side; a task with more sorts its rows.
WRITERS = 128


@contextmanager
def unsorted_text(spark: SparkSession) -> Iterator[None]:
    """Text that is written in folders in this block is not sorted by folder before; wide lines would spill."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(WRITERS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def footers(spark: SparkSession) -> Iterator[None]:
    """Parquet read in this block goes through the reader that can take counts from footers."""
    key = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(key)
    spark.conf.set(key, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written in this block leaves no shuffle files; else they stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def configured(spark: SparkSession) -> Iterator[SparkSession]:
    """The settings for the time of a block; afterwards the session has its own ones again."""
    before = {key: spark.conf.get(key, None) for key in RUNTIME_CONF}
    try:
        yield configure(spark)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def local_session(cpus: int | str = 8, app_name: str = "voltlog", memory: str = "8g",
                  shared_folder: str | None = None) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    if shared_folder:
        builder = builder.config("spark.checkpoint.dir", shared_folder)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared one named in ``spark.checkpoint.dir``, or in the warehouse if unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/voltlog-{uuid.uuid4().hex}"
