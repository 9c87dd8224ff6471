"""Columns with names of the operators' own or with dots, and texts with very many matches."""

import time
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltlog.llm import decontaminate, jaccard, licenses, merkle, mixing, pii, quality, spelling, stages, toxicity

NAMES = ("_body", "_low", "_lower", "_plain", "_hit", "_doc", "_hash", "_judged", "_score", "_row", "_text", "_base", "_id",
         "_rank_row", "a.b", "SCORES", "x y", "back`tick")
TEXTS = ["mail a.b@c.org or call +49 170 1234567", "Licensed under CC BY 4.0. All rights reserved.", "", None,
         "one two three four five six seven eight nine"]


@pytest.fixture(scope="module")
def odd(spark):
    names = ", ".join("`" + n.replace("`", "``") + "` long" for n in NAMES)
    rows = [(i, t, "en", "s", 3, *range(len(NAMES))) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")


def some_model():
    return SimpleNamespace(of=lambda c: c["length"] / 100, limit=0.05)


def kept_columns(docs, out):
    old = [tuple(r)[: len(docs.columns)] for r in docs.collect()]
    values = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    assert sorted(map(repr, (tuple(r) for r in out.select(*values).collect()))) == sorted(map(repr, old))


@pytest.mark.parametrize("scan", ["pii", "licenses", "toxicity", "quality", "leaks", "copies"])
def test_all_columns_pass_through(spark, odd, scan):
    none = spark.createDataFrame([], "item_id long, text string")
    out = {
        "pii": lambda: pii.scan(odd, some_model()), "licenses": lambda: licenses.scan(odd),
        "toxicity": lambda: toxicity.score(odd, toxicity.Model({}, -0.15, 1.0, 0.05, (-1.0, 0.0, 0.0)), "text"),
        "quality": lambda: quality.score(odd, quality.train(np.zeros((0, len(quality.FEATURES))), np.zeros(0)), to="given"),
        "leaks": lambda: decontaminate.without_leaks(odd, none), "copies": lambda: jaccard.without_near_copies(odd),
    }[scan]()
    if scan == "copies":
        assert out.columns == odd.columns and out.count() == len(TEXTS)
    else:
        kept_columns(odd, out)


def test_redaction_keeps_columns(odd):
    out = pii.redact(odd, some_model())
    assert out.columns == odd.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[3] is None and "@" not in texts[0] and "170" not in texts[0]


def test_the_quality_stage_keeps_a_column_of_its_own_name(spark, odd, monkeypatch):
    monkeypatch.setattr(stages, "read", lambda *_: spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    monkeypatch.setattr(stages, "LEAST_QUALITY", 0.0)
    assert stages.keep_good(spark, odd, "").columns == odd.columns


def test_new_operators_take_such_columns(odd):
    assert merkle.manifest(odd).count() == mixing.mix(odd, mixing.size_in_words(F.col("text"))).count() == len(TEXTS)
    assert spelling.variants(odd).count() == 0


def spans(spark, monkeypatch, strict, candidates):
    """(start, end) of the selected ones of (start, end, probability)."""
    rows = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(4.0).alias("kind"), F.lit(p).alias("p"))
                     for a, b, p in candidates])
    monkeypatch.setattr(pii, "_candidates", lambda _: rows)
    fixed = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(0).alias("kind"), F.lit(b).alias("end")) for a, b in strict])
    base = fixed if strict else F.expr(f"cast(array() as {pii.SPAN})")
    model = SimpleNamespace(of=lambda c: c["p"], limit=0.5)
    (row,) = spark.range(1).select(pii._selected(F.lit(""), base, model).alias("s")).collect()
    return sorted((s.start, s.end) for s in row.s)


def test_only_selected_spans_take_others_away(spark, monkeypatch):
    # A touches B, B touches C: C is best, B falls, A stays
    assert spans(spark, monkeypatch, [], [(0, 5, 0.6), (4, 9, 0.7), (8, 12, 0.8)]) == [(0, 5), (8, 12)]
    # under the limit, or touching a strict match: never
    assert spans(spark, monkeypatch, [(20, 30)], [(0, 5, 0.4), (29, 40, 0.9), (40, 41, 0.9)]) == [(40, 41)]
    # ties: the longer, then the earlier
    assert spans(spark, monkeypatch, [], [(0, 4, 0.6), (3, 9, 0.6), (8, 12, 0.6)]) == [(3, 9)]
    assert spans(spark, monkeypatch, [], [(0, 4, 0.6), (3, 7, 0.6)]) == [(0, 4)]
    assert spans(spark, monkeypatch, [(0, 3), (2, 6)], [(7, 9, 0.1)]) == []


def test_texts_with_very_many_matches(spark):
    """Time goes with the number of matches, not with its square."""

    def took(scan, text):
        begin = time.time()
        (row,) = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
        return time.time() - begin, row

    model = SimpleNamespace(of=lambda c: c["length"] * 0 + 0.9, limit=0.5)
    for scan, text in (
        (licenses.scan, lambda n: "all rights reserved under the mit license . " * n),
        (lambda d: pii.scan(d, model), lambda n: " ".join(f"user{i}@mail{i}.org" for i in range(n))),
    ):
        took(scan, text(10))
        few, _ = took(scan, text(600))
        many, row = took(scan, text(6000))
        assert many < 30 * few + 5
        assert len(row.base["reserved"]) == 6000 if "detections" in row else len(row.base) == 6000
