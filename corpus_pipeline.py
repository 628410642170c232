"""From raw documents to token ids: five stages, each one operator over all that its predecessor kept.

1. languages: documents without a letter, or whose words are of no certain language (a mean best
   probability below LEAST_SCORE), go; a text that changes between languages stays. If no document has a language
   to learn from, only those without a letter go.
2. near_copies: of each group of near copies the document with the smallest id stays.
3. decontaminate: documents with a window of 10 words of a benchmark item go.
4. identifiers: personal data is replaced by its kind in angle brackets; all documents stay.
5. pieces: texts become piece ids.

Every stage but the last returns the columns of ``documents``. ``run`` writes each stage's
result as Parquet to the shared folder and reads it as the next one's input, so a lost
executor costs a part of one stage. Columns beyond id, text and language are carried
along whatever their names: the stages work on numbered columns.

Edge cases: null and empty texts have no letter and go in the first stage; documents with a null
id go through the other stages but are in no group of near copies; of repeated rows one stays; an empty
table stays empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulebox.llm import decontaminate, identifiers, languages, near_copies, pieces
from joulebox.llm.tables import held_out, read
from joulebox.session import delete_path, scratch_path, staging

#: Mean best probability of a document's words below which it is rejected.
LEAST_SCORE = 0.4


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns c0, c1, ...; the new names by the old; and the way back."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    back = lambda df: df.select(*[F.col(n).alias(c) for c, n in names.items()])
    return docs.toDF(*names.values()), names, back


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, name, back = _numbered(docs)
    cols = {"id_col": name["doc_id"], "text_col": name["text"]}
    model = languages.fit(own, ~held_out(F.col(name["doc_id"]), 5, 0), lang_col=name["lang"], **cols)
    if model is None:
        return back(own.where(languages.has_letter(F.col(name["text"]))))
    found = languages.identify(own, model, keep=own.columns, pred_col="found", score_col="share", sure_col="sure", **cols)
    return back(found.where((F.col("found") != languages.UNKNOWN) & (F.col("sure") >= LEAST_SCORE)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, name, back = _numbered(docs)
    return back(near_copies.keep_one(own, id_col=name["doc_id"], text_col=name["text"]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, name, back = _numbered(docs)
    found = decontaminate.contamination(own, read(spark, sf_dir, "benchmark"), keep=own.columns, text_col=name["text"])
    return back(found.where(~F.col("contaminated")))


def redact_identifiers(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, name, back = _numbered(docs)
    return back(identifiers.redact(own, id_col=name["doc_id"], text_col=name["text"]))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str, model_path: str = pieces.MODEL_PATH) -> DataFrame:
    """(doc_id, lang, source, n_pieces, ids)."""
    own, name, _ = _numbered(docs)
    coded = pieces.encode(own.select(name["doc_id"], name["lang"], name["source"], name["text"]), pieces.load_vocabulary(model_path), text_col=name["text"], drop_text=True)
    return coded.select(*[F.col(name[c]).alias(c) for c in ("doc_id", "lang", "source")], F.size("ids").alias("n_pieces"), "ids")


STAGES = [
    ("languages", keep_languages),
    ("near_copies", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("identifiers", redact_identifiers),
    ("pieces", encode_pieces),
]

#: SQL can't express the learned model, the signatures or Viterbi; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = read(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex[:12]}")
        with staging(spark):  # what the stage has staged goes as soon as its result is written
            step(spark, docs, sf_dir).write.parquet(path)
        if last:
            delete_path(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
