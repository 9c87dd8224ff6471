"""Merkle manifest of a dataset: a tree of hashes per group, and one over the groups' roots.

1. Each row becomes a leaf in one narrow pass; only ids and digests go on. Leaves are numbered per group.
2. Going up, superblocks of 3^``levels`` neighbouring nodes are reduced to one node each, round by round, so a
   group of any size is dealt out in pieces of bounded size. The same rounds reduce the groups' roots.
3. Going down, the nodes of a superblock are cogrouped with the outer nodes that their proofs need, which is one
   row: the siblings on the way from the superblock to the root. Each task finishes the local reduction,
   joins local and outer siblings to proofs and folds the received leaves up to the root.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlog.llm.common import stored
from voltlog.llm.ranks import numbered

FAN = 3
#: Levels that a task reduces at a time: superblocks of 729 nodes.
LEVELS = 6
#: Siblings on the way up, one entry per level: digests before and after the own one, as hex text.
WAY = "lefts array<string>, rights array<string>, subroot string, root string"


def encoded(value: Column) -> Column:
    """``-`` for null, else number of UTF-8 bytes, colon, value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]).cast("binary"), 256))


def digest_of(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def climb(nodes: list[str], total: int, levels: int) -> list[list[str]]:
    """The nodes, then those of each level above, until one is left in the whole tree or ``levels`` are done.

    ``total`` is the number of nodes of the whole tree on the level of ``nodes``.
    """
    rows = [nodes]
    while total > 1 and len(rows) <= levels:
        rows.append([digest_of(rows[-1][i : i + FAN]) for i in range(0, len(rows[-1]), FAN)])
        total = -(-total // FAN)
    return rows


def ways(rows: list[list[str]]) -> list[tuple[list[str], list[str]]]:
    """For each of the lowest nodes, the siblings before and after it on every level."""
    beside = []
    for row in rows[:-1]:
        beside.append([
            ("".join(row[i - i % FAN : i]), "".join(row[i + 1 : i - i % FAN + FAN])) for i in range(len(row))
        ])
    out = []
    for i in range(len(rows[0])):
        steps = [level[i // FAN**no] for no, level in enumerate(beside)]
        out.append(([s[0] for s in steps], [s[1] for s in steps]))
    return out


def folded(digest: str, lefts: Sequence[str], rights: Sequence[str]) -> str:
    """The root that a leaf and the siblings on its way give."""
    for left, right in zip(lefts, rights, strict=True):
        digest = digest_of((left, digest, right))
    return digest


def _up(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes (``tree``, ``pos``, ``total``, ``digest``), then those of each round, until a tree is one node."""

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        total = int(rows["total"].iloc[0])
        top = climb([d.hex() for d in rows["digest"]], total, levels)[-1]
        return pd.DataFrame({
            "tree": rows["tree"].iloc[:1], "pos": [int(rows["block"].iloc[0])],
            "total": [-(-total // FAN**levels)], "digest": [bytes.fromhex(top[0])],
        })

    most = nodes.agg(F.max("total")).first()[0] or 1
    rounds = [nodes]
    while most > 1 or len(rounds) == 1:
        blocks = _blocks(rounds[-1], levels).select("tree", "block", "pos", "total", "digest")
        above = blocks.groupBy("tree", "block").applyInPandas(
            reduce, "tree string, pos long, total long, digest binary"
        )
        rounds.append(stored(above))
        most = -(-most // FAN**levels)
    return rounds


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {FAN**levels}"))


def _down(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """The ways of the nodes to the root, from those of the nodes above them."""

    def extend(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        top = outer.iloc[0]
        own = [d.hex() for d in rows["digest"]]
        found = ways(climb(own, int(rows["total"].iloc[0]), levels))
        return pd.DataFrame({
            "tree": key[0], "pos": rows["pos"].to_numpy(), "digest": own,
            "lefts": [[*f[0], *top["lefts"]] for f in found],
            "rights": [[*f[1], *top["rights"]] for f in found], "subroot": top["subroot"], "root": top["root"],
        })

    inner = _blocks(nodes, levels).select("tree", "block", "pos", "total", "digest").groupBy("tree", "block")
    outer = above.withColumnRenamed("pos", "block").groupBy("tree", "block")
    return inner.cogroup(outer).applyInPandas(extend, f"tree string, pos long, digest string, {WAY}")


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    doc_id: str = "doc_id",
    group: str = "source",
    received: dict[str, Column] | None = None,
    levels: int = LEVELS,
    with_proofs: bool = True,
) -> DataFrame:
    """One row per row: its ``leaf``, the ``subroot`` of its group, the ``root``, its ``proof``, and its check.

    ``leaf`` is the hash of ``fields``, each ``-`` if null, else length in bytes, colon, value. The leaves of
    a group are ordered by ``doc_id`` (null first), and by the leaf itself where ids are equal; every three
    neighbours give a node of the level above, until one is left. The groups' roots, ordered by the group's name
    (null first, by bytes), go on in the same way. ``proof`` has the siblings that lead from the leaf to the root,
    left to right on each level; ``proof_sha256`` is the hash of all of them. ``received`` names fields as they
    came back from elsewhere: ``folded_root`` is what the leaf of those and the proof give, ``verified``
    whether that is ``root``. Nothing else of the row goes on, so further columns have no effect.

    Null and empty texts are leaves like others. Repeated rows are leaves with equal hashes; which of
    them has which place makes no difference to the rows returned. No rows give no rows. A task holds
    3^``levels`` nodes and the way above them, whatever the size of a group.
    """
    name = lambda c: F.col("`" + c.replace("`", "``") + "`")
    values = {f: name(f) for f in fields}
    came = values | (received or {})
    own, got = leaf_of(list(values.values())), leaf_of(list(came.values()))
    id_type = docs.select(name(doc_id)).schema[0].dataType.simpleString()
    leaves = stored(docs.select(
        name(doc_id).alias("id"),
        F.when(name(group).isNull(), "").otherwise(F.concat(F.lit("+"), name(group).cast("string"))).alias("tree"),
        own.alias("digest"),
        # null: as it was
        F.nullif(got, own).alias("got") if received else F.lit(None).cast("binary").alias("got"),
    ))
    leaves = numbered(leaves, "tree", ["id", "digest"])
    rounds = _up(leaves, levels)
    tops = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    forest = stored(numbered(tops, "tree", ["name"]))
    roots = _up(forest, levels)
    way = roots[-1].select(
        "tree", "pos", F.array().cast("array<string>").alias("lefts"), F.array().cast("array<string>").alias("rights"),
        F.lit("").alias("subroot"), F.lower(F.hex("digest")).alias("root"),
    )
    for nodes in reversed(roots[:-1]):
        way = _down(nodes, way.select("tree", "pos", "lefts", "rights", "subroot", "root"), levels)
    way = stored(forest.select("pos", "name").join(way.drop("tree"), "pos").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "lefts", "rights",
        F.col("digest").alias("subroot"), "root",
    ))
    for nodes in reversed(rounds[1:-1]):
        way = stored(_down(nodes, way.select("tree", "pos", "lefts", "rights", "subroot", "root"), levels))

    def finish(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        top = outer.iloc[0]
        out_left, out_right = list(top["lefts"]), list(top["rights"])
        outer_siblings = "".join(a + b for a, b in zip(out_left, out_right, strict=True))
        leaf = [d.hex() for d in rows["digest"]]
        proofs, sums, folds = [], [], []
        for i, (lefts, rights) in enumerate(ways(climb(leaf, int(rows["total"].iloc[0]), levels))):
            siblings = "".join(a + b for a, b in zip(lefts, rights, strict=True)) + outer_siblings
            proofs.append(siblings)
            sums.append(digest_of((siblings,)))
            changed = rows["got"].iloc[i]
            folds.append(folded(leaf[i] if changed is None else changed.hex(), lefts + out_left, rights + out_right))
        out = pd.DataFrame({
            "doc_id": rows["id"].to_numpy(), "leaf": leaf, "subroot": top["subroot"], "root": top["root"],
            "proof": proofs, "proof_sha256": sums, "folded_root": folds,
            "verified": [f == top["root"] for f in folds],
        })
        return out if with_proofs else out.drop(columns="proof")

    # ids travel as text: pandas would turn numbers beside nulls into inexact ones
    inner = _blocks(leaves, levels).select(
        "tree", "block", "pos", "total", F.col("id").cast("string").alias("id"), "digest", "got"
    ).groupBy("tree", "block")
    outer = way.select("tree", F.col("pos").alias("block"), "lefts", "rights", "subroot", "root").groupBy("tree", "block")
    found = inner.cogroup(outer).applyInPandas(
        finish,
        "doc_id string, leaf string, subroot string, root string, " + "proof string, " * with_proofs
        + "proof_sha256 string, folded_root string, verified boolean",
    ).withColumn("doc_id", F.col("doc_id").cast(id_type))
    if not with_proofs:
        return found
    split = F.filter(F.split("proof", "(?<=\\G.{64})"), lambda d: d != "")
    return found.withColumn("proof", split)
