"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the number of copies that each of its documents has in the mean: some whole
copies and a fraction. Two documents with fractions meet: mass moves from one to the other, in a random
direction, until one of them has none or a whole copy; no mass is made or lost, and the odds keep each document's
mean. The other one goes on as residual and meets the next. This runs in pieces of ``FAN`` documents side by side;
the residuals of the pieces are the documents of the next round, until one per source is left. So a source's
words differ from its target by the rounding of one document at most, which is taken in part.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlog.llm.common import let, stored
from voltlog.llm.ranks import numbered

#: Documents that one piece rounds.
FAN = 128
#: Mass is counted in whole parts of a word, so that nothing gets lost in sums.
UNIT = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: the words that the mix takes of the source.

    Sources by code point, null last, have ``weights`` in turn. All targets are ``share`` (a fraction) of all
    sizes; none is above ``most`` times its source's size, and what is too much for one goes to the others by weight.
    A round finds the sources that are too small for their part; sources in one table, sums on the driver.
    """
    ranked = numbered(
        sizes.select("source", "source_size", F.lit("").alias("_all"), F.col("source").isNull().alias("_last")),
        "_all", ["_last", "source"],
    )
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("pos") % len(weights)).cast("int"))
    rows = stored(ranked.select("source", "source_size", weight.cast("long").alias("weight")))
    whole = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    over, under = share
    full = F.lit(False)
    before = None
    while True:
        sums = rows.agg(
            F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if (sums["full"], sums["weight"]) == before or not sums["weight"]:
            break
        before = (sums["full"], sums["weight"])
        # words for each unit of weight, as a fraction of whole numbers
        left, parts = over * whole - under * most * sums["full"], under * sums["weight"]
        wanted = F.col("weight").cast("decimal(38,0)") * F.lit(left).cast("decimal(38,0)")
        full = wanted >= F.col("source_size").cast("decimal(38,0)") * F.lit(most * parts)
        target = F.when(full, (most * F.col("source_size")).cast("double")).otherwise(
            F.col("weight") * F.lit(float(left)) / F.lit(float(parts))
        )
    if before is None:
        target = F.lit(0.0)
    elif not sums["weight"]:
        target = (most * F.col("source_size")).cast("double")
    return stored(rows.select("source", "source_size", target.alias("target")))


def _chance(seed: int, round_no: int) -> Callable[[Column], Column]:
    """A number from 0 to 1 for each meeting, the same in every run."""
    return lambda doc: F.pmod(
        F.xxhash64(F.lit(seed), F.lit(round_no), doc["name"], doc["place"]), F.lit(1 << 30)
    ) / F.lit(float(1 << 30))


def _moved(held: Column, doc: Column, chance: Column) -> Column:
    """The mass, signed, that goes from ``doc`` to ``held``: as much as there is, or as there is room for.

    Each way has the odds of the other way's mass, so the mean of either document stays as it is.
    """
    down = F.least(held["mass"], doc["full"] - doc["mass"])
    up = F.least(doc["mass"], held["full"] - held["mass"])
    return F.when(chance * (down + up) < up, -down).otherwise(up)


def _piece(docs: Column, fields: list[str], chance: Callable[[Column], Column]) -> Column:
    """Rounds the documents of an array one after the other: those that are whole now, and the one that is left."""
    kind = lambda c: F.struct(*[c[f].alias(f) for f in fields])
    with_mass = lambda c, mass: F.struct(*[(mass if f == "mass" else c[f]).alias(f) for f in fields])

    def step(state: Column, doc: Column) -> Column:
        held = state["held"]
        moved = _moved(held, doc, chance(doc))
        after = lambda m: F.struct(
            with_mass(held, held["mass"] + m).alias("a"), with_mass(doc, doc["mass"] - m).alias("b")
        )
        done = lambda c: (c["mass"] == 0) | (c["mass"] == c["full"])
        chosen = lambda pair: F.struct(
            F.concat(state["whole"], F.array(F.when(done(pair["a"]), pair["a"]).otherwise(pair["b"]))).alias("whole"),
            F.when(done(pair["a"]), pair["b"]).otherwise(pair["a"]).alias("held"),
        )
        return let(let(moved, after), chosen)

    begin = F.struct(
        F.filter(F.slice(docs, 1, 1), lambda _: F.lit(False)).alias("whole"), kind(docs[0]).alias("held")
    )
    return F.aggregate(F.slice(docs, 2, F.size(docs)), begin, step)


def mix(
    docs: DataFrame,
    size: Column,
    source: str = "source",
    doc_id: str = "doc_id",
    weights: tuple[int, ...] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    most: int = 2,
    seed: int = 11,
    fan: int = FAN,
) -> DataFrame:
    """One row per row: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``part``.

    ``copies`` is how often the mix takes the whole document; ``part`` is the number of its first words that
    it takes besides, which only the one document of a source has whose fraction stays to the end. ``size`` is the
    number of words. See ``targets`` for the other parameters. In the mean over seeds, a document is taken
    as often as its source's target over its source's size; with one seed, every run gives the same.

    A null source is a source of its own, the last one. Null and empty texts have size 0 and no copies beyond the
    whole ones. Rows with equal ids, also repeated rows, are documents of their own; which of equal rows gets
    a copy makes no difference to the rows returned. No rows give no rows. A piece holds ``fan`` documents
    whatever the size of a source.
    """
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(stored(sizes), weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = goals.withColumn("whole", F.floor(rate).cast("long")).withColumn("fraction", rate - F.floor(rate))
    named = rows.join(goals.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    named = named.drop("_source").withColumns({
        "full": F.col("size") * UNIT,
        "mass": F.round(F.col("fraction") * F.col("size") * UNIT).cast("long"),
        "name": F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit("")),
    })
    kept = ["doc_id", "source", "size", "source_size", "target", "whole"]
    is_whole = (F.col("mass") == 0) | (F.col("mass") == F.col("full"))
    # in an order that has nothing to do with the table's
    mixed = named.where(~is_whole).withColumn("_order", F.xxhash64(F.lit(seed), "doc_id"))
    todo = numbered(mixed, "name", ["_order", "doc_id", "size"])
    fields = ["place", "name", *kept, "full", "mass"]
    out = [named.where(is_whole).select(*kept, "full", "mass")]
    left = todo.agg(F.max("total")).first()[0] or 0
    todo = todo.withColumn("place", F.col("pos"))
    round_no = 0
    while left > 1:
        pieces = todo.withColumn("_piece", F.expr(f"pos div {fan}")).groupBy("name", "_piece").agg(
            F.sort_array(F.collect_list(F.struct(F.col("pos").alias("at"), *fields))).alias("_docs")
        )
        rounded = stored(pieces.select(
            "name", F.col("_piece").alias("pos"),
            _piece(F.transform("_docs", lambda d: F.struct(*[d[f].alias(f) for f in fields])), fields,
                   _chance(seed, round_no)).alias("_done"),
        ))
        out.append(rounded.select(F.explode("_done.whole").alias("d")).select(*[f"d.{f}" for f in [*kept, "full", "mass"]]))
        todo = rounded.select("pos", *[F.col(f"_done.held.{f}").alias(f) for f in fields])
        left = -(-left // fan)
        round_no += 1
    out.append(todo.select(*kept, "full", "mass"))
    every = reduce(DataFrame.unionByName, out)
    up = (F.col("mass") == F.col("full")) & (F.col("full") > 0)
    return every.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("whole") + up.cast("long")).alias("copies"),
        F.when(up, F.lit(0)).otherwise(F.round(F.col("mass") / UNIT)).cast("long").alias("part"),
    )
