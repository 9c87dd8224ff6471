"""The registered query of each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlog.llm import (
    decontaminate, jaccard, licenses, merkle, mixing, neighbours, oracles, packing, pii, quality, shards, spelling,
    toxicity, url_filter,
)
from voltlog.llm.common import held_out, read, utf8

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)
SHARDS = 16
TOKENIZER = "word_bpe_49k.json"


def _stable(column: str) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(1 << 30))


def op1_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = utf8(F.col("text"))
    rows = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.md5(body).alias("group"),
        _stable("lang").alias("lang_place"),
        _stable("source").alias("source_place"),
    )
    out = shards.shard(
        rows,
        weight=F.col("size"),
        group=F.col("group"),
        dimensions={
            "size": F.log2("size"), "lang": F.col("lang_place"), "source": F.col("source_place"),
            "doc_id": F.col("doc_id"),
        },
        shards=SHARDS,
    )
    return out.select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter.judge(read(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


def op3_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return out.select(
        "doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op4_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items found in documents; documents without any have no row."""
    out = decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "start", "matched", F.col("score").alias("overlap"))


def op5_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model)
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("passages").alias("n_passages"),
    )


def op6_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    places = F.concat(*[F.col("base")[label] for _, label in licenses.BASE])
    return out.select(
        "doc_id", "n_words", places.alias("places"), "base_labels", "labels", "score"
    ).select(
        "doc_id", "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.concat_ws(",", "base_labels").alias("base_labels"),
        F.concat_ws(",", "labels").alias("labels"),
        "score",
    )


def op7_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    out = quality.score(docs, model)
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op8_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard.join(read(spark, sf_dir, "documents").select("doc_id", "text"), k=4, percent=85)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "class_id", "n_links")


def op9_small_world_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op10_personal_data_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.scan(docs, pii.fit(docs))
    counts = [
        F.size(F.filter("base", _is_kind(i))).cast("long").alias(f"n_{kind}") for i, kind in enumerate(pii.STRICT)
    ]
    return out.select(
        "doc_id", *counts,
        F.sha2(pii.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents; half of them come back without their line breaks."""
    text, even = F.col("text"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    received = {"text": F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)}
    return merkle.manifest(read(spark, sf_dir, "documents"), received=received, with_proofs=False)


def op12_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = mixing.mix(docs, mixing.size_in_words(F.col("text")))
    return out.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size") + F.col("part")).alias("taken"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents").select("doc_id", "text"))


def base_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op2 that rules alone decide: its host, path and rule, and the verdict of that rule."""
    out = op2_url_trees(spark, sf_dir)
    return out.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("verdict"))


def base_license_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op6 that its base phrases alone decide."""
    return op6_license_rules(spark, sf_dir).drop("labels", "score")


def _is_kind(i: int) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == i


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith(("op", "base_")) and callable(f)}


def oracle_sql() -> dict[str, str]:
    """Where SQL can express a query; the others are tested against plain Python or held-out labels."""
    return {
        "op4_spaced_seed_decontamination": oracles.LEAKS, "op8_signature_tree_join": oracles.JACCARD,
        "base_url_rules": oracles.url_rules(URL_RULES), "base_license_places": oracles.LICENSE_BASE,
        "op11_merkle_manifest": oracles.MERKLE, "op13_spelling_variants": oracles.SPELLING,
    }
