"""Near-duplicates by BagMinHash signatures, banding and exact verification.

A document is the bag of its runs of ``SHINGLE`` words; two are near copies if the
weighted Jaccard similarity of the bags (sum of minima over sum of maxima) is at
least ``THRESHOLD``.

Signatures: the weight of a shingle (its count) is cut into the intervals
(0,1], (1,2], (2,4], (4,8], ... Each interval has a Poisson process of points, with a
rate in proportion to its length; a point has a time, a component of the signature
and a place in its interval, all drawn from the shingle's hash, and counts when its
place lies within the weight. A component is the earliest time that counts, so
two documents agree on one with a probability of exactly their similarity.
Points are generated in order of time and stop as soon as they come later than
every component's present time, so a document costs about one point for each
shingle and a few hundred more.

Search: documents with equal bags collapse to the smallest id. ``BANDS`` bands of
``ROWS`` components put the others in buckets. Bags whose sizes differ by more than the
threshold can't be similar, so a bucket falls into classes of size (each document is in its
own class and the next, so that no similar two are kept apart), and of buckets with the same
documents one is kept. First every bucket's smallest id is compared with all of it, which
connects most of a group of near copies. In a bucket that still holds several components, all pairs left to
test have a document outside the largest one: those are compared, by signature, with all
documents of other components, and where ``LEAST_AGREEING`` components agree, exactly by their bags, in the same task, best ones
first; a document that is linked to a component needs no more pairs there. Components of the verified links are the classes.

Chance to miss a pair of similarity 0.8: (1 - 0.8**4)**24 < 4e-6 by the bands, about
5e-5 by the agreement test (four standard deviations).

Edge cases: documents without words, or with a null id, are in no group (class
id: their own id). Texts of fewer than five words are one shingle. Repeated rows
are equal bags, so they are one class; ``keep_one`` keeps one of rows with the same id and text (by
128 bits of hash). Rows that share an id but not a text are one node, which has one of their signatures: they
stay or go together. Very long texts are one bag each, a block of their own. Extra columns, whatever their
names, are ignored by ``classes`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import stage
from .textblock import U64, Spans, blocks, gram_hash, list_column, mix, ranges

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
#: Components of a signature: the bands take the first BANDS * ROWS, the agreement test takes all.
SIZE = 352
#: Of SIZE components; 0.8 less four standard deviations of the estimate.
LEAST_AGREEING = int(SIZE * 0.8 - 4 * (SIZE * 0.8 * 0.2) ** 0.5)
#: Nodes of a bucket, and shingles of their bags, that one group of rows holds at most, or about.
CHUNK = 20_000
CHUNK_SHINGLES = 2_000_000
BLOCK_BYTES = 1 << 20


def bags(words: Spans, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, count), by row; a row of fewer words than ``shingle`` has one."""
    h = words.hashes()
    grams = gram_hash(h, shingle)
    at = np.arange(len(grams))
    at = at[words.row[: len(grams)] == words.row[shingle - 1 :]] if len(grams) else at
    row, value = words.row[at], grams[at]
    n = words.counts
    short = np.flatnonzero((n > 0) & (n < shingle))
    if len(short):
        own = np.zeros(len(short), U64)
        for k in range(shingle - 1):
            has = n[short] > k
            own[has] = mix(own[has] * U64(0x9E3779B97F4A7C15) + h[words.first[short[has]] + k] + U64(1))
        row, value = np.concatenate([row, short]), np.concatenate([value, own])
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    if not len(row):
        return row, value, np.zeros(0, np.int64)
    new = np.append(True, (row[1:] != row[:-1]) | (value[1:] != value[:-1]))
    begin = np.flatnonzero(new)
    return row[begin], value[begin], np.diff(np.append(begin, len(row)))


def signatures(row: np.ndarray, value: np.ndarray, count: np.ndarray, rows: int, size: int) -> np.ndarray:
    """BagMinHash signatures (rows x size, as 32-bit patterns) of bags; rows without shingles stay at infinity."""
    sig = np.full(rows * size, np.inf)
    place = [np.arange(len(row))]
    start, width = [np.zeros(len(row), np.int64)], [np.ones(len(row), np.int64)]
    low = 1
    while len(over := np.flatnonzero(count > low)):
        place.append(over)
        start.append(np.full(len(over), low))
        width.append(np.full(len(over), low))
        low *= 2
    item = np.concatenate(place)
    start, width = np.concatenate(start), np.concatenate(width)
    seed = mix(value[item] + start.astype(U64) * U64(0xD1342543DE82EF95))
    row, count = row[item], count[item]
    t = np.zeros(len(item))
    latest = np.full(rows, np.inf)
    step = 0
    while len(row):
        step += 1
        draw = mix(seed + U64(step * 0x9E3779B97F4A7C15 % (1 << 64)))
        where = mix(draw ^ U64(0xA0761D6478BD642F))
        unit = ((draw >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53
        t = t - np.log(unit) / (size * width)
        part = ((where >> U64(32)) * U64(size) >> U64(32)).astype(np.int64)
        level = start + ((where & U64(0xFFFFFFFF)) * width.astype(U64) >> U64(32)).astype(np.int64)
        counts = level < count
        slot = row * size + part
        np.minimum.at(sig, slot[counts], t[counts])
        live = np.unique(row)
        latest[live] = sig.reshape(rows, size)[live].max(axis=1)
        stay = t < latest[row]
        seed, row, count, t, start, width = seed[stay], row[stay], count[stay], t[stay], start[stay], width[stay]
    return sig.astype(np.float32).view(np.uint32).reshape(rows, size)


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row with words and an id: doc, fingerprint of its bag (f1, f2), band keys, 8 bits of each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in blocks(batch.column(1), BLOCK_BYTES):
                n = hi - lo
                row, value, count = bags(Spans(data, offs), SHINGLE)
                full = np.zeros(n, bool)
                full[row] = True
                f1, f2 = np.zeros(n, U64), np.zeros(n, U64)
                c = count.astype(U64)
                np.add.at(f1, row, mix(value ^ U64(0x5851F42D4C957F2D)) * c)
                np.add.at(f2, row, mix(value ^ mix(c)))
                sig = signatures(row, value, count, n, SIZE)
                keys = np.empty((n, BANDS), U64)
                for b in range(BANDS):
                    k = np.full(n, b + 1, U64)
                    for j in range(ROWS):
                        k = mix(k * U64(0x9E3779B97F4A7C15) + sig[:, b * ROWS + j])
                    keys[:, b] = k
                small = mix(sig.astype(U64)).astype(np.uint8)[full]
                m = int(full.sum())
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, n).filter(pa.array(full)),
                        pa.array(f1[full].view(np.int64)),
                        pa.array(f2[full].view(np.int64)),
                        pa.array(np.bincount(row, weights=count, minlength=n).astype(np.int64)[full]),
                        list_column(keys[full].view(np.int64).ravel(), np.full(m, BANDS), pa.int64()),
                        list_column(small.view(np.int8).ravel(), np.full(m, SIZE), pa.int8()),
                    ],
                    ["doc", "f1", "f2", "size", "keys", "sig"],
                )

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc long, f1 long, f2 long, size long, keys array<long>, sig array<tinyint>")


def _similar(pairs: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) of (a, b, text_a, text_b) whose bags are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pick = []
            n, left = batch.num_rows, batch.column(2)
            both = pa.concat_arrays([left, batch.column(3)]).take(pa.array(np.arange(2 * n).reshape(2, n).T.ravel()))
            half = None
            for lo, hi, data, offs in blocks(both, BLOCK_BYTES):
                row, value, count = bags(Spans(data, offs), SHINGLE)
                edge = np.searchsorted(row, np.arange(hi - lo + 1))
                for i in range(lo, hi):
                    e, f = edge[i - lo], edge[i - lo + 1]
                    mine = value[e:f], count[e:f]
                    if i % 2 == 0:
                        half = mine
                        continue
                    _, x, y = np.intersect1d(half[0], mine[0], assume_unique=True, return_indices=True)
                    least = int(np.minimum(half[1][x], mine[1][y]).sum())
                    total = int(half[1].sum() + mine[1].sum()) - least
                    if total and least >= threshold * total:
                        pick.append(i // 2)
            chosen = pa.array(pick, pa.int64())
            yield pa.record_batch([batch.column(0).take(chosen), batch.column(1).take(chosen)], ["a", "b"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _different(buckets: DataFrame) -> DataFrame:
    """Of the buckets (key, node) those with two nodes or more, and only one of those with the same nodes.

    A group of near copies fills many bands' buckets with the very same nodes.
    """
    sets = buckets.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(2))).alias("y")
    )
    one = sets.where("n > 1").groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key")
    return buckets.join(one, "key")


def _agreeing(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """The (a, b) whose signatures agree on LEAST_AGREEING components."""
    side = {c: sigs.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}")) for c in "ab"}
    agree = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return pairs.join(side["a"], "a").join(side["b"], "b").where(agree >= LEAST_AGREEING).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The similar ones of (a, b), stored."""
    text = {c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab"}
    return stage(_similar(pairs.join(text["a"], "a").join(text["b"], "b"), threshold).distinct(), "links")


def _leader_links(nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links of each bucket's smallest node: one pair per node and bucket, whatever the bucket's size."""
    buckets = nodes.select("node", F.explode("keys").alias("key"))
    leaders = buckets.groupBy("key").agg(F.min("node").alias("a"))
    pairs = buckets.join(leaders, "key").where("node != a").select("a", F.col("node").alias("b")).distinct()
    return _verified(_agreeing(pairs, nodes), texts, threshold)


def _bags(texts: DataFrame) -> DataFrame:
    """(node, size, values, counts): the bag of each text (node, text), by shingle hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in blocks(batch.column(1), BLOCK_BYTES):
                row, value, count = bags(Spans(data, offs), SHINGLE)
                n = np.bincount(row, minlength=hi - lo)
                lists = list_column(value.view(np.int64), n, pa.int64()), list_column(count.astype(np.int32), n, pa.int32())
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), *lists], ["node", "size", "values", "counts"])

    return texts.select("node", "text").mapInArrow(run, "node long, size long, values array<long>, counts array<int>")


def _open_nodes(nodes: DataFrame, comps: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, comp, sig, size, values, counts, keys, at): nodes of buckets with two components or more.

    ``keys`` are their open buckets in order, ``at`` says for each (key, big, chunks); big is the bucket's component with
    most nodes. Signatures and bags are joined to nodes, not to their places in buckets.
    """
    placed = nodes.select("node", "keys").join(comps, "node").select("node", "comp", F.explode("keys").alias("key"))
    sizes = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    big = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("n", "comp")).alias("m"))
    big = big.where("comps > 1").select("key", F.col("m.comp").alias("big"))
    own = stage(placed.join(big, "key"), "open-places")
    bag = stage(_bags(texts.join(own.select("node").distinct(), "node", "left_semi")).dropDuplicates(["node"]), "bags")
    load = own.join(bag.select("node", "size"), "node").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    chunks = load.select("key", F.greatest(F.ceil(F.col("n") / CHUNK), F.ceil(F.col("size") / CHUNK_SHINGLES)).cast("int").alias("chunks"))
    here = F.sort_array(F.collect_list(F.struct("key", "big", "chunks")))  # two for each band at most
    own = own.join(chunks, "key").groupBy("node").agg(F.min("comp").alias("comp"), here.alias("at"))
    return nodes.select("node", "sig").join(own, "node").join(bag, "node").withColumn("keys", F.col("at.key"))


class Group:
    """Nodes of a bucket side by side."""

    def __init__(self, parts: list[pa.RecordBatch]):
        t = pa.Table.from_batches(parts).combine_chunks()
        self.node, self.comp, self.outside = (t.column(c).to_numpy() for c in ("node", "comp", "outside"))
        self.sig = t.column("sig").combine_chunks().flatten().to_numpy().reshape(len(self.node), SIZE)
        self.keys, self.key_edge = self._lists(t.column("keys"))
        self.values, self.edge = self._lists(t.column("values"))
        self.counts, _ = self._lists(t.column("counts"))
        self.values = self.values.view(U64)

    @staticmethod
    def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        column = column.combine_chunks()
        return column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])

    def similar(self, i: int, other: Group, j: int, threshold: float) -> bool:
        """Whether the bags of node i and the other group's node j are similar, exactly."""
        mine, theirs = slice(self.edge[i], self.edge[i + 1]), slice(other.edge[j], other.edge[j + 1])
        x, y, a, b = self.values[mine], other.values[theirs], self.counts[mine], other.counts[theirs]
        if not len(x) or not len(y):
            return False
        at = np.minimum(np.searchsorted(y, x), len(y) - 1)
        least = int(np.where(y[at] == x, np.minimum(a, b[at]), 0).sum())
        return least >= threshold * (int(a.sum()) + int(b.sum()) - least)

    def met_before(self, key: int, i: int, other: Group, js: np.ndarray) -> np.ndarray:
        """Whether i and each of the other group's nodes share a bucket with a smaller key: their pair belongs there."""
        mine = self.keys[self.key_edge[i] : self.key_edge[i + 1]]
        mine = mine[mine < key]
        if not len(mine) or not len(js):
            return np.zeros(len(js), bool)
        n = other.key_edge[js + 1] - other.key_edge[js]
        theirs = other.keys[ranges(other.key_edge[js], n)]
        shared = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
        return np.bincount(np.repeat(np.arange(len(js)), n)[shared], minlength=len(js)) > 0

    def links(self, key: int, sat: Group, threshold: float) -> tuple[list[int], list[int]]:
        """Links of these nodes to nodes of ``sat``, one for each component that a node meets.

        A pair of two nodes outside the big component is the smaller one's to test. Once a node is linked to a component, its
        other pairs there bring nothing new.
        """
        a, b = [], []
        for i in range(len(self.node)):
            same = (sat.sig == self.sig[i]).sum(axis=1)
            fit = np.flatnonzero((same >= LEAST_AGREEING) & (sat.comp != self.comp[i]) & (~sat.outside | (sat.node > self.node[i])))
            fit = fit[~self.met_before(key, i, sat, fit)]
            joined = set()
            for j in fit[np.lexsort((sat.node[fit], -same[fit]))].tolist():
                if sat.comp[j] not in joined and self.similar(i, sat, j, threshold):
                    joined.add(sat.comp[j])
                    a.append(int(min(self.node[i], sat.node[j])))
                    b.append(int(max(self.node[i], sat.node[j])))
        return a, b


def _open_links(open_: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links that join the components of open buckets.

    Pairs inside the big component need no test, so all pairs that are left have a node outside it. Buckets are cut into
    chunks of about CHUNK nodes or CHUNK_SHINGLES shingles, which the nodes outside visit one by one, compared by signature and then
    by their bags. A task holds a chunk and one batch of those that visit it. A pair that shares several
    buckets is tested in the one with the smallest key.
    """
    rows = open_.select("node", "comp", "sig", "keys", "values", "counts", F.explode("at").alias("at"))
    rows = rows.select("at.*", (F.col("comp") != F.col("at.big")).alias("outside"), "node", "comp", "sig", "keys", "values", "counts")
    home = F.pmod(F.xxhash64("node"), F.col("chunks").cast("long")).cast("int")
    columns = ["outside", "node", "comp", "sig", "keys", "values", "counts"]
    sat = rows.select("key", home.alias("chunk"), F.lit(False).alias("asks"), *columns)
    asks = rows.where("outside").select("key", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(True).alias("asks"), *columns)
    parts = int(open_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sat.union(asks).repartition(parts, "key", "chunk").sortWithinPartitions("key", "chunk", "asks", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sitting, group = None, [], None
        for batch in batches:
            key, chunk, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            edge = np.flatnonzero((key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1]) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(key)], strict=True):
                if hi == lo:
                    continue
                if (key[lo], chunk[lo]) != now:
                    now, sitting, group = (key[lo], chunk[lo]), [], None
                part = batch.slice(lo, hi - lo)
                if not asks[lo]:
                    sitting.append(part)
                    group = None
                    continue
                if not sitting:  # a chunk that no node has its home in
                    continue
                group = group or Group(sitting)
                a, b = Group([part]).links(int(key[lo]), group, threshold)
                if a:
                    yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) after ``links``: the components that they connect become one, with the smallest name."""
    edges = links.select(F.col("a").alias("node"), F.col("b").alias("other")).join(comps, "node").select("other", F.col("comp").alias("a"))
    edges = edges.join(comps, F.col("other") == F.col("node")).select("a", F.col("comp").alias("b")).where("a != b").distinct()
    roots = components(edges).withColumnRenamed("node", "comp")
    return stage(comps.join(roots, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp")), "comps")


def _bucket_components(nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(node, comp): components of the verified links of all nodes (node, keys, sig) that share a bucket."""
    comps = _joined(nodes.select("node", F.col("node").alias("comp")), _leader_links(nodes, texts, threshold))
    open_ = stage(_open_nodes(nodes, comps, texts), "open-buckets")  # a connected bucket needs no more
    return comps if open_.isEmpty() else _joined(comps, stage(_open_links(open_, threshold), "links"))


def classes(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, class_id) for each row with an id and words; class_id is the class's smallest id."""
    rows = stage(sketch(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "sketches")
    kept = rows.groupBy("f1", "f2").agg(F.min(F.struct("doc", "row")).alias("m")).select("f1", "f2", F.col("m.doc").alias("node"), F.col("m.row").alias("row"))
    kept = stage(kept, "equal-bags")
    first = rows.join(kept.select("row"), "row", "left_semi").withColumnRenamed("doc", "node")
    banded = first.select("node", "size", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi").select("key")
    met = stage(banded.join(shared, "key").distinct(), "shared-bands")
    grade = F.floor(F.log(F.col("size").cast("double")) / F.lit(float(np.log(1 / threshold))))
    graded = _different(met).select("node", F.explode(F.array(grade, grade + 1)).alias("grade"), "key")
    buckets = _different(graded.select(F.xxhash64("key", "grade").alias("key"), "node").distinct())
    placed = stage(buckets.groupBy("node").agg(F.sort_array(F.collect_set("key")).alias("keys")), "buckets")
    sigs = first.select("node", "sig").join(placed.select("node"), "node", "left_semi").dropDuplicates(["node"])
    nodes = stage(placed.join(sigs, "node").select("node", "keys", "sig"), "bucket-nodes")
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    texts = stage(texts.join(nodes.select("node"), "node", "left_semi"), "bucket-texts")
    comps = _bucket_components(nodes, texts, threshold)
    out = rows.select("doc", "f1", "f2").join(kept.select("f1", "f2", "node"), ["f1", "f2"])
    return out.join(comps, "node", "left").select("doc", F.coalesce("comp", "node").alias("class_id"))


def label(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and class_id (the smallest id of its group, or its own)."""
    found = classes(docs, threshold, id_col, text_col).groupBy("doc").agg(F.min("class_id").alias("class_id"))
    ids = docs.select(F.col(id_col))
    return ids.join(found, ids[id_col] == found["doc"], "left").select(id_col, F.coalesce("class_id", F.col(id_col).cast("long")).alias("class_id"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but the smallest id of each group, and without its repeated rows.

    Rows with a null id, or without words, all stay.
    """
    found = classes(docs, threshold, id_col, text_col).groupBy("doc").agg(F.min("class_id").alias("class_id"))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # columns of any name
    own, doc, text = docs.toDF(*names.values()), F.col(names[id_col]), F.col(names[text_col])
    own = own.join(found, doc.cast("long") == F.col("doc"), "left").where("class_id is null or class_id = doc")
    # repeated rows by hash, which Spark merges before it shuffles; rows without a class all stay
    apart = F.when(F.col("class_id").isNull(), F.monotonically_increasing_id())
    marks = {"m0": doc, "m1": F.xxhash64(text, F.lit(1)), "m2": F.xxhash64(text, F.lit(2)), "m3": apart}
    return own.withColumns(marks).dropDuplicates(list(marks)).select(*[F.col(n).alias(c) for c, n in names.items()])
