"""Toxic passages as maximum-scoring segments of token log-odds.

Training counts words per class on a bounded sample of labelled rows and turns them into log-odds
with a Dirichlet prior. Scoring walks over each text once: every segment whose summed log-odds cannot
be improved by growing or shrinking is found in linear time. Segment scores are judged by the
extreme-value law that the best segments of harmless texts follow.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlog.llm.common import labelled_texts, named, others, packed, small_batches, stored, unpacked

WORD = re.compile(r"[^\W\d_]+")
#: Besides words, their beginnings of these lengths have log-odds, written with a hyphen.
PREFIXES = (8, 7, 6, 5)
SEGMENT = "start int, end int, score double, expected double"


@dataclass
class Model:
    """``odds``: score of each known word; other words have the negative score ``drift``.

    ``rate`` and ``size`` are the parameters of the extreme-value law: among harmless texts of n
    words, about ``size * n * exp(-rate * s)`` segments score s or more. ``weights`` turn what is
    found in a text into a probability.
    """

    odds: dict[str, float]
    drift: float
    rate: float
    size: float
    weights: tuple[float, ...]


def segments(scores: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first word, behind the last, score), in order.

    ``scores`` are places and scores of the known words; all others score ``drift`` (negative).
    A stack of candidates holds, for each, the sums before and behind it; each word enters once and
    each merge removes a candidate, so the time is linear.
    """
    open_: list[list[float]] = []  # first word, behind the last, sum before, sum behind
    at, total = 0, 0.0
    for place, score in scores:
        total += drift * (place - at)
        at = place + 1
        left, total = total, total + score
        if score <= 0:
            continue
        new = [place, at, left, total]
        while True:
            j = len(open_) - 1
            while j >= 0 and open_[j][2] >= new[2]:
                j -= 1
            if j < 0 or open_[j][3] >= new[3]:
                open_.append(new)
                break
            new = [open_[j][0], new[1], open_[j][2], new[3]]
            del open_[j:]
    return [(int(a), int(b), behind - before) for a, b, before, behind in open_]


class WordOdds(dict):
    """Score of a word: that of the word itself if known, else of its longest known beginning, else 0.

    Words already met are kept, up to a bound; then that begins anew.
    """

    def __init__(self, odds: dict[str, float]):
        super().__init__()
        self.odds = odds

    def __missing__(self, word: str) -> float:
        score = self.odds.get(word, 0.0)
        for n in PREFIXES:
            if score:
                break
            if len(word) > n:
                score = self.odds.get(f"{word[:n]}-", 0.0)
        if len(self) >= 250_000:
            self.clear()
        self[word] = score
        return score


def found_in(text: str, model: Model, odds: WordOdds) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of words of the text, and its maximal segments."""
    words = WORD.findall(text.lower())
    hits = [(i, score) for i, w in enumerate(words) if (score := odds[w])]
    return len(words), segments(hits, model.drift)


def evidence(words: int, parts: list[tuple[int, int, float]], model: Model) -> tuple[float, float, float]:
    """What the probability is made of: bias, surprise of the best segment, and of all of them."""
    if not parts:
        return 1.0, 0.0, 0.0
    surprise = [max(0.0, model.rate * s - math.log(model.size * max(words, 1))) for _, _, s in parts]
    return 1.0, min(max(surprise), 30.0), math.log1p(min(sum(surprise), 1e4))


def probability(x: tuple[float, float, float], weights: tuple[float, ...]) -> float:
    z = sum(a * b for a, b in zip(x, weights, strict=True))
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _longer_than(n: int) -> Callable[[Column], Column]:
    return lambda word: F.length(word) > n


def _beginning(n: int) -> Callable[[Column], Column]:
    return lambda word: F.concat(F.left(word, F.lit(n)), F.lit("-"))


def _token_counts(sample: DataFrame) -> DataFrame:
    """Per token, how many texts of either half hold it (``all0``, ``all1``), and how many of label 1.

    A token counts once per text, so a text that repeats one word does not make it typical.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    begun = [F.transform(F.filter("words", _longer_than(n)), _beginning(n)) for n in PREFIXES]
    tokens = sample.select("half", "label", words.alias("words")).select(
        "half", "label", F.explode(F.array_distinct(F.concat("words", *begun))).alias("token")
    )
    return tokens.groupBy("token").agg(
        *[F.count_if(F.col("half") == h).cast("double").alias(f"all{h}") for h in (0, 1)],
        *[F.count_if((F.col("half") == h) & (F.col("label") == 1)).cast("double").alias(f"ones{h}") for h in (0, 1)],
    )


def _log_odds(
    counts: DataFrame, halves: tuple[int, ...], prior: float, most_words: int, least_z: float
) -> dict[str, float]:
    """Words and beginnings of words that clearly differ between the classes, with their log-odds."""
    counts = counts.select(
        "token",
        sum(F.col(f"all{h}") for h in halves).alias("all"),
        sum(F.col(f"ones{h}") for h in halves).alias("ones"),
    )
    sums = counts.agg(F.sum("ones").alias("ones"), F.sum("all").alias("all")).first()
    n, n1 = float(sums["all"] or 0), float(sums["ones"] or 0)
    n0 = n - n1
    if n1 == 0 or n0 == 0:
        return {}
    own = F.col("all") / n * prior + 0.5
    y1, y0 = F.col("ones") + own, F.col("all") - F.col("ones") + own
    delta = F.log(y1 / (F.lit(n1 + prior) - y1)) - F.log(y0 / (F.lit(n0 + prior) - y0))
    z = delta / F.sqrt(1 / y1 + 1 / y0)
    best = (
        counts.where(F.col("all") >= 4).select("token", delta.alias("delta"), z.alias("z"))
        .where((F.abs("z") >= least_z) & F.col("delta").isNotNull())
        .orderBy(F.desc(F.abs("z")), "token")
        .limit(most_words)
        .collect()
    )
    return {r["token"]: max(-2.0, min(8.0, r["delta"])) for r in best}


def _extreme_value_law(tops: np.ndarray, words: np.ndarray) -> tuple[float, float]:
    """Rate and size of the law, by moments of the best scores less their growth with length."""
    if len(tops) < 20 or tops.std() < 1e-6:
        return 1.0, 0.05
    rate = 1.0
    for _ in range(20):
        spread = (tops - np.log(words) / rate).std()
        rate = float(np.clip(math.pi / (max(spread, 1e-3) * math.sqrt(6.0)), 0.05, 5.0))
    rest = tops - np.log(words) / rate
    mode = rest.mean() - 0.5772 / rate
    return rate, float(np.clip(math.exp(min(50.0, rate * mode)), 1e-6, 1e3))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Weights of a logistic regression, by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * 0.1
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    target: str = "toxic",
    sample_rows: int = 30_000,
    prior: float = 500.0,
    most_words: int = 20_000,
    least_z: float = 3.2,
    drift: float = -0.15,
) -> Model:
    """The model, from at most ``sample_rows`` labelled rows that are not held out.

    ``most_words`` bounds the table of log-odds, ``least_z`` is how many standard deviations a
    word's log-odds must differ from 0. The extreme-value law and the weights are learned from texts
    scored with the log-odds of the other half of the sample, so that words learned by heart don't
    count; the model's own log-odds use both halves. Without labels of both kinds every text gets
    half the share of label 1, or 0.
    """
    half = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)).cast("int")
    sample = stored(labelled_texts(docs, labels, target, sample_rows).withColumn("half", half))
    counts = stored(_token_counts(sample))
    first, second, odds = (_log_odds(counts, h, prior, most_words, least_z) for h in ((0,), (1,), (0, 1)))
    model = Model(odds, drift, 1.0, 0.05, (-8.0, 1.0, 1.0))

    def measured(law: Model) -> pd.DataFrame:
        """A row per text, however many segments it has: label, words, best score, evidence by a model's law."""

        def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            other = WordOdds(second), WordOdds(first)
            for batch in batches:
                rows = []
                for text, label, h in zip(batch["text"], batch["label"], batch["half"], strict=True):
                    words, parts = found_in(text, law, other[h])
                    top = max((float(s) for _, _, s in parts), default=0.0)
                    rows.append((label, words, top, [float(v) for v in evidence(words, parts, law)]))
                yield pd.DataFrame(rows, columns=["label", "words", "top", "x"])

        rows = sample.mapInPandas(measure, "label int, words int, top double, x array<double>").collect()
        # the same model whatever the order of rows
        return pd.DataFrame(sorted((r["label"], r["words"], r["top"], *r["x"]) for r in rows))

    rows = measured(model)
    label = rows[0].to_numpy(dtype=float) if len(rows) else np.zeros(0)
    if not odds or len(set(label)) < 2:
        share = float(label.mean()) / 2 if len(label) else 0.0
        return Model({}, drift, 1.0, 0.05, (math.log((share + 1e-9) / (1 - share + 1e-9)), 0.0, 0.0))
    words, tops = np.maximum(rows[1].to_numpy(dtype=float), 1), rows[2].to_numpy(dtype=float)
    harmless = (label == 0) & (tops > 0)
    rate, size = _extreme_value_law(tops[harmless], words[harmless])
    rows = measured(Model(odds, drift, rate, size, model.weights))
    return Model(odds, drift, rate, size, _logistic(rows.iloc[:, 3:].to_numpy(dtype=float), rows[0].to_numpy(dtype=float)))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (probability of label 1) and ``passages``.

    ``passages`` are the segments that fewer than one in twenty harmless texts of that length would
    hold, as word numbers (end exclusive), score and the number expected by chance; in order. Null and
    empty texts have none and the probability of a text without toxic words. Repeated rows score
    alike; no rows give no rows. Columns ``score`` and ``passages`` are replaced.
    """

    @F.pandas_udf(f"score double, passages array<struct<{SEGMENT.replace(' ', ':').replace(',:', ',')}>>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        odds = WordOdds(model.odds)
        for batch in batches:
            out = []
            for body in batch:
                words, parts = found_in(body, model, odds)
                expected = [model.size * max(words, 1) * math.exp(-model.rate * s) for _, _, s in parts]
                out.append(
                    (
                        probability(evidence(words, parts, model), model.weights),
                        [
                            {"start": a, "end": b, "score": s, "expected": e}
                            for (a, b, s), e in zip(parts, expected, strict=True)
                            if e < 0.05
                        ],
                    )
                )
            yield pd.DataFrame(out, columns=["score", "passages"])

    kept = others(docs, ("score", "passages"))
    body = F.coalesce(named(text), F.lit(""))
    return small_batches(docs).select(packed(kept), judge(body).alias("_judged")).select(
        *unpacked(kept), "_judged.score", "_judged.passages"
    )
