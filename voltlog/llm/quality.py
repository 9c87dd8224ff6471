"""Quality classifier: an additive model of lookup tables with pairwise interactions.

Each feature is cut into bins; boosting goes round the features, and each step fits a very small
tree on one feature and adds it to that feature's table. Afterwards the pairs that explain most
of what is left get tables of their own. Tasks pass over all rows and add up derivatives per cell of the tables; the
driver boosts from these sums. Scoring looks up bins and adds, for whole batches at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlog.llm.common import labelled_texts, small_batches, stored

FEATURES = (
    "log_words", "word_length", "upper_share", "digit_share", "punctuation_share", "symbol_share",
    "space_share", "high_byte_share", "line_length", "repeated_lines", "repeated_words", "top_word",
    "end_marks", "bars", "exclamations", "long_words", "compression", "control_share", "brackets",
    "all_upper_words", "symbol_words",
)

# Classes of ASCII characters.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("a") : ord("z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
for _c in b".,;:!?'\"-()":
    _CLASS[_c] = 4
for _c in b"#$%&*+/<=>@[]\\^_`{|}~":
    _CLASS[_c] = 5
for _c in b" \t\n\r":
    _CLASS[_c] = 6
_CLASS[128:] = 7
#: Repetition is measured by compressing the whole text in blocks of this size, each by itself.
_BLOCK = 4096


def features(text: str) -> list[float]:
    """The numbers of ``FEATURES`` of one whole text; an empty text has only zeros."""
    raw = text.encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(FEATURES)
    size = len(raw)
    share = np.bincount(_CLASS[np.frombuffer(raw, dtype=np.uint8)], minlength=8) / size
    words = raw.split()
    count = max(1, len(words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    packed = sum(len(zlib.compress(raw[b : b + _BLOCK], 1)) for b in range(0, size, _BLOCK))
    upper = sum(1 for w in words if len(w) > 1 and w.isupper())
    odd = sum(1 for w in words if w[-1:] in b"#$%&*|@^~=+")
    return [
        float(np.log1p(len(words))),
        (size - share[6] * size) / count,
        share[1], share[3], share[4], share[5], share[6], share[7],
        size / max(1, len(lines)) / 100.0,
        1.0 - len(set(lines)) / max(1, len(lines)),
        1.0 - len(seen) / count,
        max(seen.values(), default=0) / count,
        (raw.count(b".") + raw.count(b"?")) / count,
        raw.count(b"|") / count,
        raw.count(b"!") / count,
        sum(1 for w in words if len(w) > 18) / count,
        packed / size,
        share[0],
        (raw.count(b"[") + raw.count(b"{") + raw.count(b"<")) / count,
        upper / count,
        odd / count,
    ]


@dataclass
class Model:
    """``edges`` cut each feature into bins; ``tables`` and ``pairs`` hold what a bin adds."""

    start: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def places(self, b: np.ndarray) -> np.ndarray:
        """The sum of what the bins of each row add."""
        z = np.full(len(b), self.start)
        for j, table in enumerate(self.tables):
            z += table[b[:, j]]
        for i, j, table in self.pairs:
            z += table[b[:, i], b[:, j]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.places(self.bins(x)), -30, 30)))


def _step(grad: np.ndarray, hess: np.ndarray, ridge: float) -> np.ndarray:
    """What a tree of at most three leaves over neighbouring bins adds to each bin."""
    leaves = [(0, len(grad))]
    for _ in range(2):
        best = (1e-9, None)
        for a, b in leaves:
            if b - a < 2:
                continue
            g, h = np.cumsum(grad[a:b]), np.cumsum(hess[a:b])
            gain = g[:-1] ** 2 / (h[:-1] + ridge) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + ridge)
            gain -= g[-1] ** 2 / (h[-1] + ridge)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (a, a + k + 1, b))
        if best[1] is None:
            break
        a, cut, b = best[1]
        leaves = [x for x in leaves if x != (a, b)] + [(a, cut), (cut, b)]
    out = np.zeros(len(grad))
    for a, b in leaves:
        out[a:b] = grad[a:b].sum() / (hess[a:b].sum() + ridge)
    return out


def _shallow(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """What a shallow tree adds to each cell of two features: one cut of the first, then bins of the second on either side."""
    gi, hi = np.cumsum(g.sum(1)), np.cumsum(h.sum(1))
    gain = gi[:-1] ** 2 / (hi[:-1] + ridge) + (gi[-1] - gi[:-1]) ** 2 / (hi[-1] - hi[:-1] + ridge)
    cut = int(np.argmax(gain)) + 1 if len(gain) else 1
    add = np.zeros(g.shape)
    for part in (slice(0, cut), slice(cut, None)):
        add[part] = _step(g[part].sum(0), h[part].sum(0), 4 * ridge)
    return add


def train(
    x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, rate: float = 0.1, pairs: int = 6,
    ridge: float = 5.0,
) -> Model:
    """The model of labels ``y`` (0 or 1), from rows in memory; a constant when only one label occurs."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    start = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)
             for j in range(len(FEATURES))]
    model = Model(start, edges, [np.zeros(len(e) + 1) for e in edges], [])
    if len(set(y)) < 2:
        return model
    b = model.bins(x)
    z = np.full(len(y), start)

    def sums(index: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-z))
        return np.bincount(index, y - p, cells), np.bincount(index, p * (1 - p), cells)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            add = rate * _step(*sums(b[:, j], len(table)), ridge)
            table += add
            z += add[b[:, j]]
    gains = []
    for i in range(len(edges)):
        for j in range(i):
            cells = (len(edges[i]) + 1) * (len(edges[j]) + 1)
            g, h = sums(b[:, i] * (len(edges[j]) + 1) + b[:, j], cells)
            gains.append((float((g**2 / (h + 4 * ridge)).sum() / cells**0.5), i, j))
    for _, i, j in sorted(gains, reverse=True)[:pairs]:
        model.pairs.append((i, j, np.zeros((len(edges[i]) + 1, len(edges[j]) + 1))))
    for _ in range(rounds // 4):
        for i, j, table in model.pairs:
            index = b[:, i] * table.shape[1] + b[:, j]
            add = rate * _shallow(*(s.reshape(table.shape) for s in sums(index, table.size)), ridge)
            table += add
            z += add[b[:, i], b[:, j]]
    return model


#: Rows up to this many are trained from on the driver; more stay in tasks, which pass over them.
DRIVER_ROWS = 20_000
#: What a row adds to a sum is rounded to this fraction, so that sums are exact in any order of the rows.
UNIT = 1 << 24
#: Bits of a number's 32 that name its step; quantiles are looked for among steps (relative width: a thousandth).
STEP_BITS = 13
#: Rounds between two passes over the rows, for the tables of features and for those of pairs.
ROUNDS_A_PASS, PAIR_ROUNDS_A_PASS = 5, 2
#: Rows of a block and rows that a task looks at in a pass, besides the first four tasks.
BLOCK, TASK_ROWS = 1 << 14, 200_000


def _steps(x: np.ndarray) -> np.ndarray:
    """The step of each number, in the order of the numbers."""
    bits = x.astype(np.float32).view(np.int32)
    return (bits ^ ((bits >> 31) & 0x7FFFFFFF)) >> STEP_BITS


def _least(step: np.ndarray) -> np.ndarray:
    """The least number of a step."""
    bits = (step << STEP_BITS).astype(np.int32)
    return (bits ^ ((bits >> 31) & 0x7FFFFFFF)).view(np.float32).astype(float)


def _edges(step: np.ndarray, many: np.ndarray, bins: int) -> np.ndarray:
    """Where the bins of a feature begin, from its sorted steps and the number of rows of each."""
    if not len(step):
        return np.zeros(0)
    upto = np.cumsum(many)
    at = np.linspace(0, 1, bins + 1)[1:-1] * (upto[-1] - 1)
    return np.unique(_least(step[np.searchsorted(upto, at, side="right")]))


@dataclass
class Sums:
    """What a pass over the rows adds up; all numbers are whole, in parts of ``UNIT``.

    ``grad`` and ``hess`` have the first and second derivatives per cell of each table that was asked for,
    ``both`` the second ones per cell of every two features.
    """

    grad: list[np.ndarray]
    hess: list[np.ndarray]
    both: dict[tuple[int, int], np.ndarray]

    def __add__(self, other: Sums) -> Sums:
        add = lambda xs, ys: [x + y for x, y in zip(xs, ys, strict=True)]
        return Sums(
            add(self.grad, other.grad), add(self.hess, other.hess), {k: v + other.both[k] for k, v in self.both.items()}
        )


#: Which sums a pass is asked for: those of features, of all pairs of features, of the model's own pairs.
SINGLE, ALL_PAIRS, OWN_PAIRS = range(3)


def _sums(model: Model, b: np.ndarray, y: np.ndarray, kind: int) -> Sums:
    """The sums over a block of rows, of their bins and labels."""
    b = b.astype(np.intp)
    p = 1.0 / (1.0 + np.exp(-np.clip(model.places(b), -30, 30)))
    g, w = np.rint((y - p) * UNIT), np.rint(p * (1 - p) * UNIT)
    cells = [len(t) for t in model.tables]
    over = lambda i, j, v: np.bincount(b[:, i] * cells[j] + b[:, j], v, cells[i] * cells[j])
    every = [(i, j) for i in range(len(cells)) for j in range(i)]
    if kind == SINGLE:
        return Sums(
            [np.bincount(b[:, j], g, n) for j, n in enumerate(cells)],
            [np.bincount(b[:, j], w, n) for j, n in enumerate(cells)],
            {(i, j): over(i, j, w).reshape(cells[i], cells[j]) for i, j in every},
        )
    asked = every if kind == ALL_PAIRS else [(i, j) for i, j, _ in model.pairs]
    return Sums([over(i, j, g) for i, j in asked], [over(i, j, w) for i, j in asked], {})


def _learned(
    model: Model, passed: Callable[[Model, int], Sums], rounds: int, rate: float, pairs: int, ridge: float
) -> Model:
    """Boosts the tables of ``model``; ``passed`` adds up over all rows at the model as it is.

    Between two passes the gradient of a feature follows the changes of the others by the second derivatives
    that every two features share, so a few rounds need no rows: what a pass returns has a size that
    depends on the bins alone. The tables of pairs are few steps from a pass to the next.
    """
    done = 0
    while done < rounds:
        sums = passed(model, SINGLE)
        grad, hess = [g / UNIT for g in sums.grad], [h / UNIT for h in sums.hess]
        both = {k: v / UNIT for k, v in sums.both.items()}
        for _ in range(min(ROUNDS_A_PASS, rounds - done)):
            for j, table in enumerate(model.tables):
                add = rate * _step(grad[j], hess[j], ridge)
                table += add
                for i in range(len(grad)):
                    grad[i] = grad[i] - (hess[j] * add if i == j else both[i, j] @ add if i > j else add @ both[j, i])
        done += ROUNDS_A_PASS
    cells, gains = [len(t) for t in model.tables], []
    sums = passed(model, ALL_PAIRS)
    every = [(i, j) for i in range(len(cells)) for j in range(i)]
    for (i, j), g, h in zip(every, sums.grad, sums.hess, strict=True):
        g, h = g / UNIT, h / UNIT
        gains.append((float((g**2 / (h + 4 * ridge)).sum() / (cells[i] * cells[j]) ** 0.5), i, j))
    for _, i, j in sorted(gains, reverse=True)[:pairs]:
        model.pairs.append((i, j, np.zeros((cells[i], cells[j]))))
    done, rounds = 0, rounds // 4
    while done < rounds and model.pairs:
        sums = passed(model, OWN_PAIRS)
        for (_, _, table), g, h in zip(model.pairs, sums.grad, sums.hess, strict=True):
            g, h = (s.reshape(table.shape) / UNIT for s in (g, h))
            for _ in range(min(PAIR_ROUNDS_A_PASS, rounds - done)):
                add = rate * _shallow(g, h, ridge)
                table += add
                g = g - h * add
        done += PAIR_ROUNDS_A_PASS
    return model


def _begin(edges: list[np.ndarray], ones: float, rows: float) -> Model:
    share = (ones + 0.5) / (rows + 1.0)
    return Model(float(np.log(share / (1 - share))), edges, [np.zeros(len(e) + 1) for e in edges], [])


def fit(
    docs: DataFrame, labels: DataFrame, target: str = "quality", bins: int = 32, rounds: int = 120, rate: float = 0.1,
    pairs: int = 6, ridge: float = 5.0,
) -> Model:
    """The model, from all labelled rows that are not held out.

    Of more than ``DRIVER_ROWS`` rows the bins, 21 bytes a row, stay in written blocks that tasks pass over; the driver
    sees sums per cell of the tables, whose number depends on the bins alone, and boosts a few rounds from each pass.
    Of fewer rows the numbers come to the driver, which boosts them step by step. Labels other than 0 and 1 and null ids are left out;
    without any labels every text scores one half.
    """
    rows = labelled_texts(docs, labels, target).select("text", "label")
    many = len(FEATURES)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([features(t) for t in batch["text"]], dtype=float).reshape(-1, many)
            yield pd.DataFrame({"x": list(x), "steps": list(_steps(x)), "label": batch["label"]})

    measured = stored(rows.mapInPandas(measure, "x array<double>, steps array<int>, label int"))
    count = measured.count()
    if count <= DRIVER_ROWS:
        few = measured.select("x", "label").toPandas()
        x = np.array(few["x"].tolist(), dtype=float).reshape(-1, many)
        order = np.lexsort([*x.T, few["label"].to_numpy()])  # the same model whatever the order of rows
        return train(x[order], few["label"].to_numpy(dtype=float)[order], bins, rounds, rate, pairs, ridge)
    found = (
        measured.select("label", F.posexplode("steps").alias("feature", "step"))
        .groupBy("feature", "step").agg(F.count(F.lit(1)).alias("many"), F.sum("label").alias("ones"))
        .orderBy("feature", "step").toPandas()
    )
    by_feature = [found[found["feature"] == j] for j in range(many)]
    edges = [_edges(f["step"].to_numpy(), f["many"].to_numpy(), bins) for f in by_feature]
    ones = int(by_feature[0]["ones"].sum())
    model = _begin(edges, ones, count)
    if ones in (0, count):
        return model

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_list())
                y = batch["label"].to_numpy()
                for a in range(0, len(x), BLOCK):
                    part = np.column_stack([model.bins(x[a : a + BLOCK]), y[a : a + BLOCK]])
                    yield pd.DataFrame({"block": [part.astype(np.uint8).tobytes()]})

    blocks = stored(measured.select("x", "label").coalesce(4 + count // TASK_ROWS).mapInPandas(binned, "block binary")).rdd

    def passed(model: Model, kind: int) -> Sums:
        def added(part: Iterator) -> Iterator[Sums]:
            total = None
            for row in part:
                b = np.frombuffer(row["block"], dtype=np.uint8).reshape(-1, many + 1)
                sums = _sums(model, b[:, :many], b[:, many], kind)
                total = sums if total is None else total + sums
            if total is not None:
                yield total

        return blocks.mapPartitions(added).treeReduce(lambda a, b: a + b)

    return _learned(model, passed, rounds, rate, pairs, ridge)


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with a column of the probability of label 1; an existing one is replaced.

    Null and empty texts score as a text whose features are all zero. Repeated rows score alike; no
    rows give no rows.
    """

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array([features(t) for t in batch], dtype=float).reshape(-1, len(FEATURES))
            yield pd.Series(model.score(x))

    return small_batches(docs).withColumn(to, judge(F.coalesce(F.col(text), F.lit(""))))
