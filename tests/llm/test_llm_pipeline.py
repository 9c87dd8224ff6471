"""The pipeline on the smallest tables, each stage against plain Python on the rows it was given."""

import re

import brute
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from voltlog.llm import common, decontaminate, pii, quality, queries

SF = "/root/testdata/sf0.001"
tokenizers = pytest.importorskip("tokenizers")


def words_of(text):
    return [w for w in re.split(decontaminate.BREAKS, text.lower()) if w]


def holds(words, item):
    return any(words[i : i + len(item)] == item for i in range(len(words) - len(item) + 1))


def test_stages_against_plain_versions(spark):
    import public_tokenizers

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_copies", "benchmark", "personal_data", "packing"]
    source = common.read(spark, SF, "documents")
    # some odd rows: null and empty texts, an equal row, a null id
    odd = source.limit(1).union(spark.createDataFrame(
        [(900001, None, "en", "src1", None), (900002, "", None, None, 0), (None, "the end", "en", "src1", 7)], source.schema
    ))
    docs = common.stored(source.union(odd))
    texts = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)

    model = quality.fit(docs, common.read(spark, SF, "labels"))
    scores = {r.text: r.score for r in quality.score(docs, model).collect()}
    good = common.stored(stages["quality"](spark, docs, SF))
    assert texts(good) == [x for x in texts(docs) if scores[x[1]] >= 0.7]
    labels = {r.doc_id: r.quality for r in common.read(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in good.collect()}
    wrong = sum((i in kept) != bool(q) for i, q in labels.items())
    assert wrong <= 0.05 * len(labels)

    single = common.stored(stages["near_copies"](spark, good, SF))
    first = brute.components({i: t for i, t in texts(good) if i is not None}, 5, 80)
    assert texts(single) == [x for x in texts(good) if x[0] is None or first[x[0]] == x[0]]

    clean = common.stored(stages["benchmark"](spark, single, SF))
    items = [words_of(r.text) for r in common.read(spark, SF, "benchmark").collect()]
    assert texts(clean) == [x for x in texts(single) if not any(holds(words_of(x[1] or ""), i) for i in items)]

    safe = common.stored(stages["personal_data"](spark, clean, SF))
    assert safe.columns == docs.columns and safe.count() == clean.count()
    before = {r.doc_id: r.text for r in clean.collect()}
    for r in safe.collect():
        assert not brute.personal(r.text) and r.n_chars == (len(r.text) if r.text is not None else None)
        if not brute.personal(before[r.doc_id]) and "[SECRET]" not in (r.text or ""):
            assert r.text == before[r.doc_id]

    pieces = stages["packing"](spark, safe, SF).collect()
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {}
    for p in pieces:
        got.setdefault(p.doc_id, {})[p.start] = p.ids
    want = {r.doc_id: np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4").tobytes() for r in safe.collect()}
    assert {i: b"".join(x for _, x in sorted(s.items())) for i, s in got.items()} == want


def test_run_is_the_stages_in_a_row(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert rows and sum(len(r.ids) for r in rows) == 4 * sum(r.length for r in rows)


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert names["pipeline"] is corpus_pipeline.run
    assert set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op1_kd_tree_shards", "op4_spaced_seed_decontamination", "op6_license_rules", "op8_signature_tree_join"])
def test_queries_against_plain_versions(spark, name):
    got = queries.queries()[name](spark, SF).collect()
    docs = {r.doc_id: r.text for r in common.read(spark, SF, "documents").collect()}
    if name.startswith("op1"):
        assert sorted((r.doc_id, r.size) for r in got) == sorted((i, len(t.encode()) + 1) for i, t in docs.items())
        assert len({r.shard for r in got}) == 16
    elif name.startswith("op4"):
        items = {r.item_id: words_of(r.text) for r in common.read(spark, SF, "benchmark").collect()}
        whole = {(d, i) for d, t in docs.items() for i, item in items.items() if holds(words_of(t), item)}
        assert whole <= {(r.doc_id, r.item_id) for r in got}
        assert all(r.matched >= 8 for r in got)
    elif name.startswith("op6"):
        for r in got:
            words, places, labels = brute.license_places(docs[r.doc_id])
            assert (r.n_words, r.n_base, r.base_labels) == (words, len(places), labels)
            assert (r.first_word, r.last_word) == ((places[0], places[-1]) if places else (None, None))
    else:
        want = brute.components(docs, 4, 85)
        assert {r.doc_id: r.component_id for r in got} == want


def test_personal_data_query(spark):
    docs = {r.doc_id: r.text for r in common.read(spark, SF, "documents").collect()}
    for r in queries.op10_personal_data_trees(spark, SF).collect():
        found = brute.personal(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in found) for i in range(4)]
        assert r.base_sha256 == brute.sha(brute.personal_text(docs[r.doc_id]))
        base = brute.personal_text(docs[r.doc_id])
        assert not base or set(base.split(",")) <= set(r.spans.split(","))
    assert pii.KINDS[:4] == brute.KINDS


def test_held_out_rule(spark):
    import zlib

    rows = spark.range(200).select("id", common.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    with duckdb.connect() as checker:
        for table in ("documents", "benchmark", "pages"):
            checker.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        result = checker.execute(queries.oracle_sql()[name])
        columns = [c[0] for c in result.description]
        want = sorted(result.fetchall())
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == want
