"""Queries of the copy operators: op7, op6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import near_copies, substrings
from .registry import register
from .tables import read

OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, s, w[s : s + 12] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13)),
f AS (SELECT k, min(doc_id) AS low FROM g GROUP BY k HAVING count(*) > 1),
r AS (SELECT DISTINCT g.doc_id, unnest(range(g.s, g.s + 13)) AS p FROM g JOIN f ON g.k = f.k WHERE f.low < g.doc_id),
n AS (SELECT doc_id, count(*) AS n_removed, list(p) AS ps FROM r GROUP BY doc_id),
a AS (SELECT d.doc_id, w, coalesce(n_removed, 0) AS n_removed, coalesce(ps, []) AS ps FROM d LEFT JOIN n USING (doc_id)),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d WHERE len(w) > 0),
t AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.p) AS kept FROM x LEFT JOIN r ON x.doc_id = r.doc_id AND x.p = r.p WHERE r.p IS NULL GROUP BY x.doc_id)
SELECT a.doc_id, len(w) AS n_words, n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM a LEFT JOIN t USING (doc_id)
"""


@register("op7_substrings", OP7_SQL)
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs, digest=True)


@register("op6_near_copies")
def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.label(read(spark, sf_dir, "documents").select("doc_id", "text"))
