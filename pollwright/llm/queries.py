"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollwright.llm import (
    decontamination,
    extraction,
    jaccard,
    languages,
    neighbours,
    passages,
    perspectives,
    pieces,
    ranking,
    repair,
    sharding,
    toxicity,
    whitening,
)
from pollwright.llm.common import fold, small_batches, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(run: Callable[[SparkSession, str], DataFrame]):
    @wraps(run)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = query
    return query


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@register
def op2_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


ORACLES["op2_spaced_seeds"] = decontamination.oracle()


@register
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=90)


ORACLES["op3_ngram_jaccard"] = jaccard.oracle(3, 90)


@register
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = pieces.round_trip(table(spark, sf_dir, "documents"), piece_model())
    digits = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(digits.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@register
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    marks = table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    weights = toxicity.learn(docs.filter(~held_out), marks.filter(~held_out))
    return toxicity.score(docs, weights).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@register
def op7_extendible_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


ORACLES["op7_extendible_hashing"] = sharding.oracle()


@register
def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = languages.learn(docs.filter(~held_out))
    return languages.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages"
    )


@register
def op9_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


@register
def op10_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perspectives.rotate(table(spark, sf_dir, "conversations"))
    span = F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["stop"]))
    return found.withColumn("spans", F.array_join(span, ","))


ORACLES["op10_perspectives"] = perspectives.oracle()


@register
def op5_collinear_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@register
def op1_boosted_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.learn(pages))


@register
def op13_pairwise_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    marks = table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = ranking.learn(docs.filter(~held_out), marks.filter(~held_out))
    return ranking.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@register
def op11_multiplicity_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register
def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair.report(repair.damage(turns), every=turns)


ORACLES["op12_structure_repair"] = repair.oracle()
