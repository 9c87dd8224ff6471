"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlog.session import freed_shuffles, scratch_folder
from voltlog.sources.hadoop import delete

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared scratch folder and read back; cuts the lineage."""
    return _written(df, scratch_folder(df.sparkSession))


def _written(df: DataFrame, folder: str) -> DataFrame:
    spark = df.sparkSession
    with freed_shuffles(spark):
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def lent(df: DataFrame) -> Iterator[DataFrame]:
    """The rows, ``stored`` until the block ends: what needs them must be written by then."""
    folder = scratch_folder(df.sparkSession)
    try:
        yield _written(df, folder)
    finally:
        delete(df.sparkSession, folder)


#: Bytes of rows that go to a Python worker at a time; the default would hold ten thousand rows of any length.
BATCH_BYTES = "8m"


def small_batches(df: DataFrame) -> DataFrame:
    """The rows, after bounding what a Python worker of this session holds of them at a time."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, also when used inside lambdas."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the ids whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def others(df: DataFrame, new: tuple[str, ...]) -> list[str]:
    """The columns that an operator passes on: all but those whose names it gives to its own."""
    return [c for c in df.columns if c.lower() not in new]


def named(column: str) -> Column:
    """The column of that very name, also where the name has dots or backticks."""
    return F.col("`" + column.replace("`", "``") + "`")


def packed(columns: list[str]) -> Column:
    """A row as one column ``_row``, so that its names meet none of an operator's own."""
    return F.struct(*[named(c) for c in columns]).alias("_row")


def unpacked(columns: list[str]) -> list[Column]:
    return [F.col("_row").getField(c).alias(c) for c in columns]


def utf8(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def bounded_sample(df: DataFrame, key: Column, most: int, seed: int = 17) -> DataFrame:
    """About ``most`` rows, at most, chosen by a hash of ``key``; all rows if there are fewer.

    One count decides the share, the hash decides the rows, so a rerun chooses the same ones.
    """
    rows = df.count()
    if rows <= most:
        return df
    share = int(0.97 * most / rows * 1_000_000)
    return df.where(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_000)) < share).limit(most)


#: Labels up to this many (two numbers each) are sent to all tasks to pick their texts; more are joined.
MOST_LABELS = 1_000_000


def labelled_texts(docs: DataFrame, labels: DataFrame, target: str, most: int | None = None) -> DataFrame:
    """(doc_id, text, label) of the labelled rows that may be learned from: all, or a bounded sample of ``most`` labels.

    Up to ``MOST_LABELS`` labels are broadcast, and the texts of the other documents are not shuffled.
    """
    usable = labels.where(
        F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    ).select("doc_id", F.col(target).cast("int").alias("label"))
    usable = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    if most is not None:
        usable = F.broadcast(bounded_sample(usable, F.col("doc_id"), most))
    elif usable.count() <= MOST_LABELS:
        usable = F.broadcast(usable)
    return small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(usable, "doc_id")
