"""Upsert by key as join plus union, and the guards on its source."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Keys up to this many are sent to the rows they are joined with.
MOST_SENT = 100_000


def joined_by_number(keys: DataFrame, written: DataFrame | None = None) -> DataFrame:
    """``keys`` with the way to join them that their number allows: sent to all tasks, or shuffled and sorted.

    Spark would go by the size of files, in which ids of many megabytes take one, and send them through the driver.
    The rows of ``written`` are counted, from footers; it is ``keys`` or a written table that has at least as many.
    """
    many = (keys if written is None else written).count()
    return F.broadcast(keys) if many <= MOST_SENT else keys.hint("merge")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           replaced: DataFrame | None = None) -> DataFrame:
    """Rows of ``source`` replace those of ``target`` with the same key; nothing else goes.

    With ``replaced``, its keys leave the target instead of those of the source.
    """
    gone = (source if replaced is None else replaced).select(*keys, F.lit(True).alias("is_gone"))
    # Not written as anti join: where the target is an aggregate, the optimizer would move that
    # below it, and compare every single row of a large group instead of one per group.
    kept = target.join(gone, list(keys), "left").where(F.col("is_gone").isNull())
    return kept.select(*target.columns).unionByName(source)


def key_violations(source: DataFrame, keys: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Keys that occur more than once, or rows with a missing required column, with their count."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in (*keys, *required)])
    return (
        source.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_if(missing).alias("missing_count"))
        .where("row_count > 1 or missing_count > 0")
    )


def touched_keys(source: DataFrame, replaced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Group keys whose events change when ``source`` events replace the ``replaced`` ones."""
    return source.select(*keys).unionByName(replaced.select(*keys)).distinct()


def recompute(aggregate, enriched: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fresh aggregate rows for the touched keys, which are distinct, from all events.

    The keys are joined before the aggregation, so events of other groups are not added up. Pass
    ``touched`` as a written table: where it is small it is sent to the events, where it is not
    Spark can split groups with very many events in the join.
    """
    return aggregate(enriched.join(joined_by_number(touched), list(keys), "left_semi").select(*enriched.columns))
