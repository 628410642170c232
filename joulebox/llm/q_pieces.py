"""Queries of the tokeniser and of the whole pipeline: op9, pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import pieces
from .registry import register
from .tables import read


@register("op9_pieces")
def op9_pieces(spark: SparkSession, sf_dir: str, model_path: str = pieces.MODEL_PATH) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = pieces.load_vocabulary(model_path)
    coded = pieces.encode(docs, vocabulary, check_col="exact", drop_text=True)
    return coded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "exact")


register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
