"""Places of rows in the order of their group, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltlog.llm.common import stored


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with ``pos``, their place from 0 on in the order of their group, and ``total``, its size.

    Rows are sorted by ranges of group and order, so a group of any size is dealt over many tasks; a
    window sees one row per range and group. Rows that are equal in ``order`` are told apart by their
    place in ``rows``, which should be a written table, so that many of them are dealt out as well.
    """
    keys = [group, *order, "_rank_tie"]
    placed = stored(
        rows.withColumn("_rank_tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_rank_tie")
        .withColumn("_rank_row", F.monotonically_increasing_id())
        .withColumn("_rank_part", F.shiftright("_rank_row", 33))
    )
    counts = placed.groupBy(group, "_rank_part").agg(F.min("_rank_row").alias("_rank_least"), F.count(F.lit(1)).alias("_rank_many"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_rank_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(counts.select(
        F.col(group).alias("_rank_group"), F.col("_rank_part").alias("_rank_at"),
        (F.coalesce(F.sum("_rank_many").over(before), F.lit(0)) - F.col("_rank_least")).alias("_rank_shift"),
        F.sum("_rank_many").over(whole).alias("total"),
    ))
    same = (placed["_rank_part"] == offsets["_rank_at"]) & placed[group].eqNullSafe(offsets["_rank_group"])
    return placed.join(offsets, same).select(
        *rows.columns, (F.col("_rank_row") + F.col("_rank_shift")).alias("pos"), "total"
    )
