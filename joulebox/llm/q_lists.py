"""Queries of the list and search operators: op2, op3, op4, op10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, identifiers, topk, url_lists
from .registry import register
from .tables import read

#: The rules (verdict, host, path).
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

OP10_SQL = r"""
WITH p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

_WORDS = r"""regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP4_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, w[s : s + least(10, len(w)) - 1] AS k
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, s, n, w[s : s + n - 1] AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
             FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT dw.doc_id, dw.s, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.k = bw.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@register("op10_url_lists", OP10_SQL)
def op10_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lists.judge(read(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


@register("op4_decontaminate", OP4_SQL)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs.select("doc_id", "text"), bench.select("item_id", "text"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP2_SQL = """
WITH e AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE embedding IS NOT NULL),
bad AS (SELECT DISTINCT vec_id FROM e WHERE x IS NULL OR NOT isfinite(x)),
v AS (SELECT vec_id, i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS c FROM e WHERE vec_id NOT IN (SELECT vec_id FROM bad)),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(sum(q.c * d.c) AS BIGINT) AS score
      FROM v q JOIN v d ON q.i = d.i WHERE q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id GROUP BY q.vec_id, d.vec_id)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 10
"""


@register("op2_topk", OP2_SQL)
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


@register("op3_identifiers")
def op3_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identifiers.spans(read(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    return found.select(
        "doc_id",
        *[identifiers.count_of("base", k).alias(f"n_{k}") for k in identifiers.KINDS],
        F.sha2(identifiers.span_text("base"), 256).alias("base_sha256"),
        identifiers.span_text("spans").alias("spans"),
    )
