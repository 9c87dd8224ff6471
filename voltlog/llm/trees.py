"""Boosted trees whose scoring is a plain column expression.

Training uses Spark's own gradient-boosted trees; the fitted trees are then
written out as nested CASE expressions, so scoring stays inside generated code and also works on
array elements inside higher-order functions.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Score = Callable[[Sequence[Column]], Column]
SPLIT = re.compile(r"\s*If \(feature (\d+) <= (\S+)\)")


def _tree(lines: list[str], at: int) -> tuple[Callable[[Sequence[Column]], Column], int]:
    """The subtree that begins at line ``at`` of a printed tree, and the line after it."""
    if found := SPLIT.match(lines[at]):
        feature, limit = int(found[1]), float(found[2])
        low, at = _tree(lines, at + 1)
        high, at = _tree(lines, at + 1)  # skips the line "Else"
        return lambda x: F.when(x[feature] <= F.lit(limit), low(x)).otherwise(high(x)), at
    value = float(lines[at].split("Predict:")[1])
    return lambda x: F.lit(value), at + 1


def fit(
    sample: DataFrame,
    features: Sequence[str],
    label: str,
    trees: int = 20,
    depth: int = 3,
    step: float = 0.3,
    seed: int = 11,
    weight: str | None = None,
) -> Score:
    """Probability of label 1 as a function of feature columns, in the order of ``features``.

    ``sample`` may be of any size, as Spark's trees are trained in tasks; a column ``weight`` says how many
    rows one stands for. Missing values count as -1. With one class only, or
    no rows at all, the probability is that class (0 for no rows).
    """
    clean = sample.select(
        *[F.coalesce(F.col(f).cast("double"), F.lit(-1.0)).alias(f) for f in features],
        F.col(label).cast("double").alias("label"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_weight"),
    ).where(F.col("label").isNotNull())
    classes = {r["label"]: r["count"] for r in clean.groupBy("label").count().collect()}
    if len(classes) < 2:
        only = float(next(iter(classes), 0.0))
        return lambda x: F.lit(only)
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(clean)
    model = GBTClassifier(
        maxIter=trees, maxDepth=depth, stepSize=step, seed=seed, maxBins=64, labelCol="label", weightCol="_weight"
    ).fit(vectors.select("features", "label", "_weight"))
    parts = [
        (weight, _tree(tree.toDebugString.splitlines(), 1)[0])
        for weight, tree in zip(model.treeWeights, model.trees, strict=True)
    ]

    def score(x: Sequence[Column]) -> Column:
        x = [F.coalesce(c.cast("double"), F.lit(-1.0)) for c in x]
        margin = sum((F.lit(w) * tree(x) for w, tree in parts), F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))

    return score
