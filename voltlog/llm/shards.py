"""K-d tree sharding: equal shares of bytes, cut at weighted medians of the widest dimension.

The rows are first added up per group (rows that must stay together, such as equal texts). Each
level of the tree is a few jobs over that table: one for the extent of every node in every
dimension, and some for the weighted median, which histograms narrow down. The driver
holds the histograms of one level, a bounded number of bins for each node, and the tree.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlog.llm.common import others, stored

SCALE_BITS, HASH_BITS = 30, 32
BINS = 4096


@dataclass
class Node:
    """A box of the tree: ``shards`` leaves, numbered from ``first``, below it."""

    first: int
    shards: int
    dimension: int = -1
    cut: int = 0
    low: Node | None = None
    high: Node | None = None

    @property
    def name(self) -> int:
        return self.first

    def leaves(self) -> list[Node]:
        if self.low is None:
            return [self]
        return self.low.leaves() + self.high.leaves()

    def place(self) -> Column:
        """The first leaf number of the box that a row is in so far."""
        if self.low is None:
            return F.lit(self.first)
        return F.when(F.col(f"_k{self.dimension}") < F.lit(self.cut), self.low.place()).otherwise(
            self.high.place()
        )


def _groups(rows: DataFrame, dimensions: int) -> DataFrame:
    """One row per group: its weight and its place in each dimension, as ordered 62-bit keys.

    A key is the scaled value followed by a hash of the group, so that no two groups tie and a
    dimension with few values can still be cut at the median.
    """
    sums = stored(
        rows.groupBy("_group").agg(
            F.sum("_weight").alias("_weight"),
            *[F.min(f"_d{i}").alias(f"_d{i}") for i in range(dimensions)],
        )
    )
    ends = sums.agg(
        *[f(f"_d{i}").alias(f"{n}{i}") for i in range(dimensions) for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    keys = []
    for i in range(dimensions):
        low, high = ends[f"lo{i}"], ends[f"hi{i}"]
        width = (high - low) if low is not None and high > low else 1.0
        value = F.coalesce((F.col(f"_d{i}") - F.lit(low or 0.0)) / F.lit(width), F.lit(0.0))
        scaled = F.floor(value * F.lit(float(2**SCALE_BITS - 1))).cast("long")
        tie = F.pmod(F.xxhash64("_group", F.lit(i)), F.lit(2**HASH_BITS))
        keys.append((scaled * F.lit(2**HASH_BITS) + tie).alias(f"_k{i}"))
    return sums.select("_group", "_weight", *keys)


def _cuts(boxes: DataFrame, open_nodes: list[Node], total: dict[int, int], tolerance: float) -> None:
    """Sets the cut of each open node to the weighted quantile that its halves need."""
    low = {n.name: 0 for n in open_nodes}
    width = {n.name: 1 << (SCALE_BITS + HASH_BITS) for n in open_nodes}
    before = {n.name: 0 for n in open_nodes}
    want = {n.name: total[n.name] * (n.shards // 2) / n.shards for n in open_nodes}
    active = list(open_nodes)
    while active:
        for n in active:
            width[n.name] = max(1, -(-width[n.name] // BINS))
        key = F.coalesce(*[F.when(F.col("_box") == n.name, F.col(f"_k{n.dimension}")) for n in active])
        start = F.coalesce(*[F.when(F.col("_box") == n.name, F.lit(low[n.name]).cast("long")) for n in active])
        step = F.coalesce(*[F.when(F.col("_box") == n.name, F.lit(width[n.name]).cast("long")) for n in active])
        bins = (
            boxes.where(F.col("_box").isin([n.name for n in active]))
            .select("_box", "_weight", key.alias("_key"),
                    start.alias("_start"), step.alias("_step"))
            .where((F.col("_key") >= F.col("_start")) & (F.col("_key") - F.col("_start") < F.col("_step") * BINS))
            .groupBy("_box", F.expr("(_key - _start) div _step").alias("_bin"))
            .agg(F.sum("_weight").alias("_weight"))
            .collect()
        )
        found = {n.name: sorted((r["_bin"], r["_weight"]) for r in bins if r["_box"] == n.name) for n in active}
        rest = []
        for n in active:
            at, done = low[n.name], before[n.name]
            for b, weight in found[n.name]:
                at = low[n.name] + b * width[n.name]
                if done + weight >= want[n.name]:
                    break
                done += weight
                at += width[n.name]
            else:
                weight = 0
            share = total[n.name] / n.shards
            if weight <= tolerance * share or width[n.name] == 1:
                nearer_high = done + weight - want[n.name] < want[n.name] - done
                n.cut = at + width[n.name] if weight and nearer_high else at
            else:
                low[n.name], before[n.name] = at, done
                rest.append(n)
        active = rest


def grow(groups: DataFrame, dimensions: int, shards: int, tolerance: float = 0.002) -> Node:
    """The tree over the groups: every box is cut until it has one shard."""
    root = Node(0, shards)
    while any(n.shards > 1 for n in root.leaves()):
        open_nodes = [n for n in root.leaves() if n.shards > 1]
        boxes = groups.withColumn("_box", root.place())
        extents = {
            r["_box"]: r
            for r in boxes.groupBy("_box")
            .agg(
                F.sum("_weight").alias("total"),
                *[
                    F.max(F.shiftright(f"_k{i}", HASH_BITS)).alias(f"hi{i}")
                    for i in range(dimensions)
                ],
                *[
                    F.min(F.shiftright(f"_k{i}", HASH_BITS)).alias(f"lo{i}")
                    for i in range(dimensions)
                ],
            )
            .collect()
        }
        total = {}
        for n in open_nodes:
            r = extents.get(n.name)
            total[n.name] = r["total"] if r else 0
            widths = [r[f"hi{i}"] - r[f"lo{i}"] if r else 0 for i in range(dimensions)]
            n.dimension = widths.index(max(widths))
        _cuts(boxes, open_nodes, total, tolerance)
        for n in open_nodes:
            n.low = Node(n.first, n.shards // 2)
            n.high = Node(n.first + n.shards // 2, n.shards - n.shards // 2)
    return root


def shard(
    rows: DataFrame,
    weight: Column,
    group: Column,
    dimensions: Mapping[str, Column],
    shards: int | None = None,
    target_bytes: int | None = None,
) -> DataFrame:
    """``rows`` with two more columns: ``shard`` and ``slot`` (numbered from 0 in each shard).

    ``weight`` is what the shards get equal shares of; ``group`` names rows that stay together;
    ``dimensions`` are numbers by which neighbouring rows meet in a shard (the lowest of a group
    counts). The number of shards is given, or the total weight over ``target_bytes``.

    Missing weights count 0, missing dimensions as the lowest value; missing group keys are one
    group. A group heavier than a share is never split: its shard has that group and little else.
    Repeated rows get a slot each. No rows give no rows. Columns ``shard`` and ``slot`` are replaced.
    """
    names = list(dimensions)
    kept = others(rows, ("shard", "slot"))
    keyed = rows.select(
        F.struct(*kept).alias("_row"),
        F.coalesce(weight.cast("long"), F.lit(0)).alias("_weight"),
        group.alias("_group"),
        *[d.cast("double").alias(f"_d{i}") for i, d in enumerate(dimensions.values())],
    )
    groups = stored(_groups(keyed, len(names)))
    if shards is None:
        total = groups.agg(F.sum("_weight")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    tree = grow(groups, len(names), shards)
    placed = groups.select(F.col("_group").alias("_of"), tree.place().cast("int").alias("shard"))
    dealt = keyed.join(placed, keyed["_group"].eqNullSafe(placed["_of"])).select("_row", "shard")
    return number(dealt).select("_row.*", "shard", "slot")


def number(rows: DataFrame) -> DataFrame:
    """Adds ``slot``: 0, 1, 2… within each shard.

    The rows are fixed by a checkpoint; a window numbers them per shard and stored partition, and
    a small table of counts says where each partition begins, so no task sees a whole shard.
    """
    fixed = rows.checkpoint().withColumn("_at", F.monotonically_increasing_id())
    fixed = fixed.withColumn("_part", F.shiftright("_at", 33))
    counts = fixed.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(
        F.col("shard").alias("_s"), F.col("_part").alias("_p"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"),
    )
    within = Window.partitionBy("_part", "shard").orderBy("_at")
    numbered = fixed.withColumn("_nth", F.row_number().over(within))
    return numbered.join(
        begins, (numbered["shard"] == begins["_s"]) & (numbered["_part"] == begins["_p"])
    ).select(*rows.columns, (F.col("_begin") + F.col("_nth") - 1).alias("slot"))
