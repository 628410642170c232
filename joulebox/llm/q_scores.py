"""Queries of the learned operators: op1, op5, op8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import languages, quality, toxicity
from .registry import register
from .tables import held_out, read


def _scored(scores: DataFrame, modulus: int, remainder: int, least: float) -> DataFrame:
    return scores.select(
        "doc_id",
        held_out(F.col("doc_id"), modulus, remainder).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


@register("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    weights = quality.fit(docs, labels, ~held_out(F.col("doc_id"), 4, 2))
    return _scored(quality.quality_scores(docs, weights), 4, 2, 0.7)


@register("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    weights = toxicity.fit(docs, labels, ~held_out(F.col("doc_id"), 5, 0))
    return _scored(toxicity.toxicity_scores(docs, weights), 5, 0, 0.5)


@register("op8_languages")
def op8_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = languages.fit(docs, ~held_out(F.col("doc_id"), 5, 0))
    found = languages.identify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score")
