"""Centroid clustering of whole-number vectors by equal-average equal-variance search.

Centroids are kept sorted by the sum of their components. With S the sum, V the
deviation sqrt(sum((x - S/d)**2)) and d the width, for vector x and centroid c

    |x - c|**2  >=  (Sx - Sc)**2 / d                       (equal average)
    |x - c|**2  >=  (Sx - Sc)**2 / d  +  (Vx - Vc)**2      (and equal variance)

A vector's search starts at its own sum and scans outward on both sides. A side is
closed as soon as the first bound there is above the best distance, since sums further out are
further away; a centroid whose second bound is above it is skipped; the rest get
their exact distance in whole numbers. Bounds are floating-point numbers and reject
only beyond a margin for rounding, so results are exact, ties included (smaller number).

The kept vectors are packed once into blocks of a narrow integer type and staged;
each round is one pass over the blocks without a shuffle of vectors: a task sends
one row per cluster and batch of blocks (count and componentwise sums), which Spark adds
up. What reaches the driver or is sent to the tasks is the centroids alone, k x width numbers (at
most MAX_NUMBERS; more is refused).

Edge cases: vectors that are null, of another width, or hold a null, NaN or infinite component
take no part, nor do rows with a null id. Fewer kept vectors than k: that many
centroids; none: an empty result. Repeated rows are vectors each; among seeds of one
id the smaller vector comes first. Components end at a long's range, and so do the distances and
sums that are returned; beyond 64-bit arithmetic the work is done in Python integers. Extra columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stage

BLOCK = 4096
MAX_NUMBERS = 1 << 24
LONG_MAX = (1 << 63) - 1
_PACKED = "ids binary, kind string, body binary"
_SUMS = "cluster int, n long, sums array<decimal(38,0)>"
_KINDS = ("int8", "int16", "int32", "int64")


def whole(column: pa.Array, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are kept, their components as floor(scale * x) in int64) of a list column of floats."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offs = column.offsets.to_numpy().astype(np.int64)
    fits = (np.diff(offs) == width) & column.is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(fits)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    x = values[offs[:-1][rows][:, None] + np.arange(width)[None, :]] if width else np.zeros((len(rows), 0))
    good = np.isfinite(x).all(axis=1)
    with np.errstate(over="ignore"):
        x = np.floor(scale * x[good])
    top = x >= 2.0**63  # as a cast to long does
    out = np.where(top, 0.0, np.maximum(x, -(2.0**63))).astype(np.int64)
    out[top] = LONG_MAX
    return rows[good], out


def _narrow(m: np.ndarray) -> np.ndarray:
    lo, hi = (int(m.min()), int(m.max())) if m.size else (0, 0)
    kind = next(k for k in _KINDS if np.iinfo(k).min <= lo and hi <= np.iinfo(k).max)
    return m.astype(kind)


def pack(vectors: DataFrame, width: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """Blocks of at most BLOCK kept vectors: ids (int64), kind (dtype) and body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, m = whole(batch.column(1), width, scale)
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[rows]
            for lo in range(0, len(ids), BLOCK):
                body = _narrow(m[lo : lo + BLOCK])
                yield pa.record_batch(
                    [pa.array([ids[lo : lo + BLOCK].tobytes()], pa.binary()), pa.array([body.dtype.name]), pa.array([body.tobytes()], pa.binary())],
                    ["ids", "kind", "body"],
                )

    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    return own.where(F.col("id").isNotNull() & F.col("v").isNotNull()).mapInArrow(run, _PACKED)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for r in batch.to_pylist():
            ids = np.frombuffer(r["ids"], np.int64)
            yield ids, np.frombuffer(r["body"], r["kind"]).reshape(len(ids), width).astype(np.int64)


def seeds(packed: DataFrame, k: int, width: int, salt: str = "1:") -> np.ndarray:
    """The k vectors with the smallest sha256 of ``salt`` and their id, in that order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, m in _blocks(batches, width):
            key = [hashlib.sha256(f"{salt}{i}".encode()).hexdigest() for i in ids.tolist()]
            first = sorted(zip(key, m.tolist(), strict=True))[:k]  # a block's best k hold all it can add
            yield pa.record_batch([pa.array([f[0] for f in first]), pa.array([f[1] for f in first], pa.list_(pa.int64()))], ["key", "v"])

    best = packed.mapInArrow(run, "key string, v array<long>").orderBy("key", "v").limit(k).collect()
    return np.array([r["v"] for r in best], np.int64).reshape(len(best), width)


class Centroids:
    """Centroids in the order of their sums, ready to be searched."""

    def __init__(self, own: np.ndarray):
        self.own, self.width = own, own.shape[1]
        exact = own.astype(object)
        sums = exact.sum(axis=1) if len(own) else np.zeros(0, object)
        self.order = np.array(sorted(range(len(own)), key=lambda i: (sums[i], i)), np.int64)
        self.sum = sums[self.order].astype(np.float64)
        self.spread = _spread(own[self.order])
        self.top = int(max((abs(int(own.max())), abs(int(own.min())))) if own.size else 0)

    def nearest(self, m: np.ndarray, counter: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, exact squared distance) of each row of ``m``.

        Distances are int64, or Python integers where those could overflow.
        """
        n, k, d = len(m), len(self.own), max(1, self.width)
        limit = self.top + int(max(abs(int(m.max())), abs(int(m.min()))) if m.size else 0)
        wide = limit * limit * d >= 1 << 62
        kind = object if wide else np.int64
        own, rows = self.own.astype(kind), m.astype(kind)
        mine, spread = m.astype(np.float64).sum(axis=1), _spread(m)
        # rounding of the sums, of their squares and of the roots, far on the safe side
        slack = 1e-9 * (float(limit) ** 2 * d + 1.0)
        best = np.zeros(n, kind)
        who = np.full(n, -1, np.int64)
        right = np.searchsorted(self.sum, mine)
        left = right - 1
        up, down = np.ones(n, bool), np.ones(n, bool)
        while up.any() or down.any():
            for side, at, step in ((up, right, 1), (down, left, -1)):
                side &= (at >= 0) & (at < k)
                i = np.flatnonzero(side)
                if not len(i):
                    continue
                c = at[i]
                bound = (mine[i] - self.sum[c]) ** 2 / d
                over = best[i].astype(np.float64) * (1 + 1e-9) + slack
                seen = who[i] >= 0
                shut = seen & (bound > over)
                side[i[shut]] = False
                test = ~shut & ~(seen & (bound + (spread[i] - self.spread[c]) ** 2 > over))
                j, number = i[test], self.order[c[test]]
                if counter is not None:
                    counter["exact"] = counter.get("exact", 0) + len(j)
                far = rows[j] - own[number]
                far = (far * far).sum(axis=1)
                better = (who[j] < 0) | (far < best[j]) | ((far == best[j]) & (number < who[j]))
                better = better.astype(bool)
                best[j[better]], who[j[better]] = far[better], number[better]
                at[i] += step
        return who, best


def _spread(m: np.ndarray) -> np.ndarray:
    x = m.astype(np.float64)
    return np.sqrt(((x - x.mean(axis=1, keepdims=True)) ** 2).sum(axis=1)) if x.size else np.zeros(len(m))


def _sums(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Partial (cluster, n, sums) of the vectors nearest to each centroid, one row per cluster and batch."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Centroids(centroids)
        for batch in batches:
            n, sums = np.zeros(k, np.int64), np.zeros((k, width), object)
            for _, m in _blocks(iter([batch]), width):
                who, _ = near.nearest(m)
                small = not m.size or max(abs(int(m.max())), abs(int(m.min()))) < 1 << 40  # a block's sums fit a long
                for c in np.unique(who):
                    of = m[who == c]
                    n[c] += len(of)
                    sums[c] += (of if small else of.astype(object)).sum(axis=0).astype(object)
            hit = np.flatnonzero(n)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(hit) + 1) * width, pa.int32()), pa.array([int(x) for x in sums[hit].reshape(-1)], pa.decimal128(38, 0))
            )
            yield pa.record_batch([pa.array(hit, pa.int32()), pa.array(n[hit]), lists], ["cluster", "n", "sums"])

    return packed.mapInArrow(run, _SUMS)


def improve(packed: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: exact floors of the means of their vectors; empty ones stay."""
    part = _sums(packed, centroids).select("cluster", "n", F.posexplode("sums").alias("at", "x"))
    total = part.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    out = centroids.copy()
    for r in total.collect():  # k x width rows
        out[r["cluster"], r["at"]] = int(r["x"]) // r["n"]
    return out


def assign(packed: DataFrame, centroids: np.ndarray, id_col: str = "vec_id") -> DataFrame:
    """(id, cluster, distance) of each vector; distances end at a long's range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Centroids(centroids)
        for ids, m in _blocks(batches, centroids.shape[1]):
            who, far = near.nearest(m)
            if far.dtype == object:
                far = np.array([min(int(x), LONG_MAX) for x in far], np.int64)
            yield pa.record_batch([pa.array(ids), pa.array(who, pa.int32()), pa.array(far)], ["id", "cluster", "distance"])

    return packed.mapInArrow(run, "id long, cluster int, distance long").withColumnRenamed("id", id_col)


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, width: int = 64, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector."""
    if k * width > MAX_NUMBERS:
        raise ValueError(f"{k} centroids of {width} components: the centroids are sent to every task, at most {MAX_NUMBERS} numbers")
    spark = vectors.sparkSession
    packed = stage(pack(vectors, width, scale, id_col, vector_col), "packed-vectors")
    own = seeds(packed, k, width)
    for _ in range(rounds if len(own) else 0):
        own = improve(packed, own)
    found = stage(assign(packed, own, id_col) if len(own) else spark.createDataFrame([], f"{id_col} long, cluster int, distance long"), "clusters")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()  # k rows at most
    total = min(sum(int(r["x"]) for r in sums), LONG_MAX)
    rows = [(r["cluster"], min(int(r["x"]), LONG_MAX), total, hashlib.sha256(",".join(map(str, own[r["cluster"]].tolist())).encode()).hexdigest()) for r in sums]
    named = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
