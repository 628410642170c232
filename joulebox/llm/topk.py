"""Exact top-k search by inner product: MaxScore over shards.

Each component is a term. Within a shard a term's postings are its column, and
its impact for a query is what it adds above the least it can add there, so that impacts
are never negative. A query's terms are ordered by their bound (largest impact).
With the k-th best score so far as threshold, the terms of smallest bounds that can't
lift a vector over it together are non-essential. Essential postings are traversed; vectors
whose sum and the bound of the rest reach the threshold are probed for the other
terms, largest first, while they stay competitive. The threshold rises block by
block, and from shard to shard within a task; the tasks' best are merged.

Vectors are packed in shards, queries in blocks; each block meets each shard once. Shards
are dealt to tasks by a hash; every task reads the stored blocks, so no block passes through the driver or
is copied in a shuffle, and a task holds its own shards and a batch.

Components become floor(scale * x), whole numbers; scores are exact (float64 while
all sums stay below 2**52, Python integers beyond) and end at the range of a long.

Edge cases: vectors that are null or empty of finite numbers (a null, NaN or infinite component) take
no part, as do rows with a null id. A query does not meet rows with its own id. Missing
components of shorter vectors count as 0. Fewer candidates than k: all are returned.
Repeated rows are candidates each, ties go to the smaller id; a query id that is repeated with the same
vector is answered once. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import parts_for, stage

SHARD = 4096
QUERY_BLOCK = 256
STEP = 1024
TASK_BYTES = 64 << 20  # stored bytes of the vectors whose shards one task holds
_PACKED = "block string, ids binary, width int, body binary"


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * component) of each component, as long."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale).cast("double") * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _pack(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors (id, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size)
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                lengths = part.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                width = int(lengths.max())
                m = np.zeros((len(ids), width), np.int64)
                m[np.arange(width)[None, :] < lengths[:, None]] = part.column(1).flatten().to_numpy()
                name = hashlib.blake2b(ids.tobytes() + m.tobytes(), digest_size=16).hexdigest()  # the same if a task runs again
                yield pa.record_batch(
                    [pa.array([name]), pa.array([ids.tobytes()], pa.binary()), pa.array([width], pa.int32()), pa.array([m.tobytes()], pa.binary())],
                    ["block", "ids", "width", "body"],
                )

    return rows.mapInArrow(run, _PACKED)


def _matrix(body: bytes, width: int, to: int) -> np.ndarray:
    m = np.frombuffer(body, np.int64).reshape(-1, width) if width else np.zeros((0, 0), np.int64)
    return m if width == to else np.pad(m, ((0, 0), (0, to - width)))


class Best:
    """The k best (score, id) so far of each query of a block."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.score: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
        self.found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)

    def threshold(self, i: int) -> int | None:
        return int(self.score[i][-1]) if len(self.score[i]) == self.k else None

    def add(self, i: int, score: np.ndarray, found: np.ndarray) -> None:
        score, found = np.concatenate([self.score[i], score]), np.concatenate([self.found[i], found])
        order = np.lexsort((found, -score))[: self.k]
        self.score[i], self.found[i] = score[order], found[order]


def max_score(queries: np.ndarray, shard: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """Bring ``best`` up to date with a shard (vectors by components, whole numbers)."""
    width = queries.shape[1]
    if not len(shard) or not len(queries):
        return
    limit = int(np.abs(queries).max(initial=0)) * int(np.abs(shard).max(initial=0)) * max(1, width)
    kind = np.float64 if limit < 1 << 52 else object
    terms = np.ascontiguousarray(shard.T).astype(kind)
    high, low = terms.max(axis=1), terms.min(axis=1)
    for i, q in enumerate(queries.astype(kind)):
        least = np.minimum(q * high, q * low)
        bound = np.maximum(q * high, q * low) - least
        order = np.argsort(-bound.astype(np.float64), kind="stable")
        q, least, bound = q[order], least[order], bound[order]
        after = np.append(np.cumsum(bound[::-1])[::-1], 0)  # what the terms from here on can add
        own, base = terms[order], least.sum()
        for lo in range(0, len(ids), STEP):
            hi = min(len(ids), lo + STEP)
            alive = np.flatnonzero(ids[lo:hi] != best.ids[i]) + lo
            over = best.threshold(i)
            # essential: without any of these a vector can't reach the threshold
            essential = width if over is None else int(np.argmax(np.append(after + base < over, True)))
            if over is not None and essential == 0:
                continue
            score = q[:essential] @ own[:essential, alive] if essential else np.zeros(len(alive), kind)
            at = essential
            rest = least[at:].sum()
            while at < width and len(alive):
                # the terms not summed yet add their least and at most after[at] more
                fit = score + rest + after[at] >= over
                alive, score = alive[fit], score[fit]
                to = min(width, at + max(1, (width - at + 1) // 2))
                score = score + q[at:to] @ own[at:to, alive]
                at = to
                rest = least[at:].sum()
            if over is not None:
                fit = score >= over
                alive, score = alive[fit], score[fit]
            if len(alive):
                if kind is object:  # a long's range bounds what can be returned
                    score = np.array([min(max(int(x), -(1 << 63)), (1 << 63) - 1) for x in score])
                best.add(i, score.astype(np.int64), ids[alive])


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", groups: int | None = None
) -> DataFrame:
    """(query_id, rank, id, score): the k best candidates of every row for which ``is_query`` holds."""
    rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    numbers = whole_numbers(F.col(vector_col), scale).alias("v")
    shards = _pack(rows.select(F.col(id_col).cast("long").alias("id"), numbers), SHARD)
    asked = rows.where(is_query).select(F.col(id_col).cast("long").alias("id"), numbers).distinct()
    blocks = stage(_pack(asked, QUERY_BLOCK), "query-blocks")  # a task that runs again must meet the same blocks
    wanted = groups or parts_for(rows, TASK_BYTES)
    by_session = not groups and wanted == int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # then tasks may be joined
    shards = shards.repartition("block") if by_session else shards.repartition(wanted, "block")
    # blocks by shards without a key: a block's row meets the shards that its task holds, one after the other
    met = blocks.alias("q").hint("shuffle_replicate_nl").crossJoin(shards.alias("s")).select(
        F.col("q.block"), F.col("q.ids"), F.col("q.width"), F.col("q.body"), F.col("s.ids").alias("s_ids"), F.col("s.width").alias("s_width"), F.col("s.body").alias("s_body")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, best, queries = None, None, None

        def emit() -> pa.RecordBatch:
            n = [len(s) for s in best.score]
            return pa.record_batch(
                [pa.array(np.repeat(best.ids, n)), pa.array(np.concatenate(best.found)), pa.array(np.concatenate(best.score))], ["query_id", "id", "score"]
            )

        for batch in batches:
            for r in batch.to_pylist():
                if r["block"] != name:
                    if best is not None:
                        yield emit()
                    name = r["block"]
                    best = Best(np.frombuffer(r["ids"], np.int64), k)
                width = max(r["width"], r["s_width"])
                queries = _matrix(r["body"], r["width"], width)
                max_score(queries, _matrix(r["s_body"], r["s_width"], width), np.frombuffer(r["s_ids"], np.int64), best)
        if best is not None:
            yield emit()

    scored = met.mapInArrow(run, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
