"""Queries of the vector, archive and audit operators: op11, op12, op13."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bundles, centroids, divergence
from .registry import register
from .tables import read


def op11_sql(rounds: int = 3, k: int = 16) -> str:
    """Assignment and means as joins over components, one pair of CTEs a round."""
    nearest = """
a{n} AS (
  SELECT vec_id, c, d FROM (
    SELECT vec_id, c, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, c) AS r FROM (
      SELECT v.vec_id, m.c, CAST(sum((v.x - m.x) * (v.x - m.x)) AS BIGINT) AS d FROM v JOIN m{n} m USING (i) GROUP BY v.vec_id, m.c))
  WHERE r = 1)"""
    means = """
m{next} AS (
  SELECT m.c, m.i, coalesce(f.x, m.x) AS x FROM m{n} m LEFT JOIN (
    SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x
    FROM (SELECT a.c, v.i, sum(v.x) AS s, count(*) AS n FROM v JOIN a{n} a USING (vec_id) GROUP BY a.c, v.i)) f USING (c, i))"""
    steps = [nearest.format(n=0)]
    for n in range(rounds):
        steps += [means.format(n=n, next=n + 1), nearest.format(n=n + 1)]
    return f"""
WITH e AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = 64),
u AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM e),
bad AS (SELECT DISTINCT vec_id FROM u WHERE x IS NULL OR NOT isfinite(x)),
v AS (SELECT vec_id, i, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM u WHERE vec_id NOT IN (SELECT vec_id FROM bad)),
s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM (SELECT DISTINCT vec_id FROM v)),
m0 AS (SELECT s.c, v.i, v.x FROM s JOIN v USING (vec_id) WHERE s.c < {k}),{",".join(steps)},
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM m{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN h USING (c)
"""


@register("op11_centroids", op11_sql())
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP12_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
k AS (SELECT payload, max(page_id) AS kept FROM p WHERE strlen(payload) >= 1000 GROUP BY payload),
r AS (SELECT page_id, p.payload, CASE WHEN page_id IS DISTINCT FROM kept THEN kept END AS refers_to FROM p LEFT JOIN k USING (payload))
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM r
"""


@register("op12_bundles", OP12_SQL)
def op12_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.archive(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
           FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
             1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 1)) // (coalesce(n.n, 0) + v.v) AS p,
             1 + (CAST(1000000000 AS HUGEINT) * (k.total + 1)) // (v.n + v.v) AS q
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= 200
"""


@register("op13_divergence", OP13_SQL)
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents").select("lang", "source", "text"))
