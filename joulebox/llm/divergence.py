"""Source divergence audit: how the sources of a language differ in their words.

Single-pass in-memory indexing. A task reads its documents once and adds each one's
terms to block postings, one dictionary per (lang, source). When the block holds
BLOCK_ENTRIES entries it is spilled as a run sorted by (lang, term, source), cut into packed
pieces by hash shard of (lang, term). In a shard the pieces arrive by their first
term, so a heap merges all runs as a stream: it holds the pieces that overlap the present
term, never the shard. Each kept term comes out as one row with its sources and counts.

A language keeps the V terms that are in at least ``least`` of its documents. A
group's N is its occurrences of kept terms. With c occurrences there, a term has
p = 1 + floor(GRAIN * (c + 1) / (N + V)), and a source h answers for a source g with the
sum over kept terms of f(p, q) = floor((p - q)**2 / q), p of g and q of h. Most terms are
in neither, so the sum starts from V * f(p0, q0), p0 and q0 being what no occurrence gives, and
streamed corrections bring it to the exact value:

    + sum over terms of g of  f(p, q0) - f(p0, q0)            (by distinct count)
    + sum over terms of h of  f(p0, q) - f(p0, q0)            (by distinct count)
    + sum over terms of both of  f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

The last is added up in tasks over the postings, pair by pair of sources of one term,
in a table of bounded size that is sent on whenever it is full. Everything is whole
numbers (Python's where 64 bits could overflow); no pair of documents or terms is formed.

Edge cases: null text, lang and source are ''. A group whose documents hold no term is still
a group. A language without kept terms gives all pairs the value 0 and no terms. Each row is
a document, repeated rows included. Very long texts are cut into words at once, as bytes; a task holds
one text's words besides its block. An empty table gives an empty result. Extra columns are
ignored; a row's text is bounded by Spark's own limit only.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import parts_for, stage

GRAIN = 1_000_000_000
BLOCK_ENTRIES = 400_000
PIECE_ENTRIES = 8192
PAIR_ENTRIES = 500_000
PAIR_STEP = 1 << 20
PIECES_OUT = 64
POSTINGS_OUT = 1 << 16
_PIECE = "shard int, lang string, term binary, sources array<string>, body binary"
_POSTINGS = "lang string, term string, total long, sources array<string>, counts array<long>"

#: Bytes of terms to themselves, A-Z lower-cased; all others to a space.
_TABLE = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

#: A term's postings in one run: (source, occurrences, documents).
Postings = list[tuple[str, int, int]]


def terms(text: str) -> list[bytes]:
    """Runs of ASCII letters and characters beyond ASCII, A-Z lower-cased, as UTF-8."""
    return text.encode().translate(_TABLE).split()


class Block:
    """Block postings: (lang, source) -> occurrences and documents of each term."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.entries = 0

    def add(self, lang: str, source: str, text: str) -> None:
        own = self.groups.get((lang, source))
        if own is None:
            own = self.groups[lang, source] = Counter({b"": 0}), Counter()  # the empty term says that the group occurs
            self.entries += 1
        before, words = len(own[0]), terms(text)
        own[0].update(words)
        own[1].update(set(words))
        self.entries += len(own[0]) - before

    def pieces(self, shards: int) -> Iterator[tuple]:
        """The block as a run sorted by (lang, term, source), cut by shard: (shard, lang, first term, sources, body)."""
        for lang in sorted({g[0] for g in self.groups}):
            sources = sorted(s for x, s in self.groups if x == lang)
            groups = [self.groups[lang, s] for s in sources]
            words = sorted(set().union(*(g[0] for g in groups)))
            place = dict(zip(words, range(len(words)), strict=True))
            seed = zlib.crc32(lang.encode() + b"\0")
            shard = np.fromiter((zlib.crc32(w, seed) % shards for w in words), np.int64, len(words))
            word = np.concatenate([np.fromiter(map(place.__getitem__, g[0]), np.int64, len(g[0])) for g in groups])
            source = np.repeat(np.arange(len(groups)), [len(g[0]) for g in groups])
            count = np.concatenate([np.fromiter(g[0].values(), np.int64, len(g[0])) for g in groups])
            docs = np.concatenate([np.fromiter(map(g[1].__getitem__, g[0]), np.int64, len(g[0])) for g in groups])
            order = np.lexsort((source, word, shard[word]))
            edges = np.flatnonzero(np.diff(shard[word[order]])) + 1
            for part in np.split(order, edges):
                for lo in range(0, len(part), PIECE_ENTRIES):
                    at = part[lo : lo + PIECE_ENTRIES]
                    own, first = np.unique(word[at], return_index=True)
                    held = [words[w] for w in own.tolist()]
                    used, number = np.unique(source[at], return_inverse=True)
                    body = pack_piece(held, np.diff(np.append(first, len(at))), number, count[at], docs[at])
                    yield int(shard[own[0]]), lang, held[0], [sources[i] for i in used.tolist()], body


def pack_piece(held: list[bytes], entries: np.ndarray, source: np.ndarray, count: np.ndarray, docs: np.ndarray) -> bytes:
    """Terms in order, entries of each, and the entries' sources and counts, compressed."""
    head = np.array([len(held), len(source)], np.int64).tobytes()
    numbers = [entries.astype(np.int32), source.astype(np.int32), count.astype(np.int64), docs.astype(np.int64)]
    return zstandard.compress(head + b"".join(n.tobytes() for n in numbers) + b"\n".join(held))


def unpack_piece(sources: list[str], body: bytes) -> Iterator[tuple[bytes, Postings]]:
    raw = zstandard.decompress(body)
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    entries = np.frombuffer(raw, np.int32, n, 16).tolist()
    source = np.frombuffer(raw, np.int32, m, 16 + 4 * n).tolist()
    count, docs = np.frombuffer(raw, np.int64, 2 * m, 16 + 4 * (n + m)).reshape(2, m).tolist()
    postings = list(zip(map(sources.__getitem__, source), count, docs, strict=True))
    at = 0
    for word, size in zip(raw[16 + 4 * n + 20 * m :].split(b"\n"), entries, strict=True):
        yield word, postings[at : at + size]
        at += size


def index_runs(docs: DataFrame, shards: int, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Sorted runs of the block postings of (lang, source, text), in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spill(block: Block) -> Iterator[pa.RecordBatch]:
            kinds = {"shard": pa.int32(), "lang": pa.string(), "term": pa.binary(), "sources": pa.list_(pa.string()), "body": pa.binary()}
            pieces = block.pieces(shards)
            while some := list(islice(pieces, PIECES_OUT)):
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*some, strict=True), kinds.values(), strict=True)], list(kinds))

        block = Block()
        for batch in batches:
            lang, source, text = (batch.column(i) for i in range(3))
            for i in range(batch.num_rows):
                block.add(lang[i].as_py(), source[i].as_py(), text[i].as_py())
                if block.entries >= block_entries:
                    yield from spill(block)
                    block = Block()
        yield from spill(block)

    return docs.mapInArrow(run, _PIECE)


def merge_pieces(pieces: Iterable[tuple[tuple[str, bytes], Iterator[tuple[bytes, Postings]]]]) -> Iterator[tuple[tuple[str, bytes], Postings]]:
    """((lang, term), postings) in order, from pieces given by their language and first term."""
    heap: list[tuple[tuple[str, bytes], int, Postings, Iterator]] = []

    def pop() -> tuple[tuple[str, bytes], Postings]:
        key, n, postings, rest = heap[0]
        after = next(rest, None)
        if after is None:
            heapq.heappop(heap)
        else:
            heapq.heapreplace(heap, ((key[0], after[0]), n, after[1], rest))
        return key, postings

    for n, (first, words) in enumerate(pieces):
        while heap and heap[0][0] < first:
            yield pop()
        heapq.heappush(heap, (first, n, next(words)[1], words))
    while heap:
        yield pop()


def merge_runs(pieces: DataFrame, shards: int, least: int) -> DataFrame:
    """(lang, term, total, sources, counts) of the kept terms; the empty term lists a language's sources."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        stored = ([batch.column(c)[i].as_py() for c in range(5)] for batch in batches for i in range(batch.num_rows))
        for _, own in groupby(stored, key=lambda r: r[0]):
            merged = merge_pieces(((r[1], r[2]), unpack_piece(r[3], r[4])) for r in own)
            for key, same in groupby(merged, key=lambda m: m[0]):
                postings = [p for _, held in same for p in held]
                if sum(p[2] for p in postings) >= least or not key[1]:
                    found: dict[str, int] = {}
                    for source, n, _ in postings:
                        found[source] = found.get(source, 0) + n
                    yield *key, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def emit() -> pa.RecordBatch:
            cols = [[r[0] for r in out], [r[1].decode() for r in out], [sum(r[2].values()) for r in out], [list(r[2]) for r in out], [list(r[2].values()) for r in out]]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["lang", "term", "total", "sources", "counts"])

        size = 0
        for r in rows(batches):
            out.append(r)
            size += 1 + len(r[2])
            if size >= POSTINGS_OUT:
                yield emit()
                out, size = [], 0
        if out:
            yield emit()

    return pieces.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "lang", "term").mapInArrow(run, _POSTINGS)


def share(count: Column, of: Column) -> Column:
    """p = 1 + floor(GRAIN * (count + 1) / of), exact; 0 where ``of`` is 0."""
    up = F.lit(GRAIN).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.coalesce(_div(up, of.cast("decimal(31,0)")) + 1, F.lit(0).cast("long"))


def _div(a: Column, b: Column) -> Column:
    """Whole-number division of non-negative numbers; null by 0."""
    return F.call_function("div", a, F.nullif(b, F.lit(0).cast("long")))


def gap(p: Column, q: Column) -> Column:
    """f = floor((p - q)**2 / q); 0 where there are no terms."""
    return F.coalesce(_div((p - q) * (p - q), q), F.lit(0).cast("long"))


def shares(count: np.ndarray, of: np.ndarray) -> np.ndarray:
    if count.size and int(count.max()) >= 9_000_000_000:
        count = count.astype(object)
    return (GRAIN * (count + 1) // of + 1).astype(np.int64)


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def shared_corrections(postings: DataFrame) -> DataFrame:
    """(lang, source, item, value): partial sums of the corrections for terms that both sources have.

    ``postings``: (lang, held array of (source, c, of)), one row per term; ``of`` is N + V.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str, str], int] = {}

        def emit() -> pa.RecordBatch:
            keys = list(sums)
            cols = [pa.array([k[i] for k in keys], pa.string()) for i in range(3)]
            return pa.record_batch([*cols, pa.array(list(sums.values()), pa.int64())], ["lang", "source", "item", "value"])

        for batch in batches:
            held = batch.column(1)
            offs = held.offsets.to_numpy().astype(np.int64)
            flat = held.values
            source = flat.field(0).dictionary_encode()
            names, code = source.dictionary.to_pylist(), source.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            count = flat.field(1).to_numpy(zero_copy_only=False)
            of = flat.field(2).to_numpy(zero_copy_only=False)
            langs = batch.column(0).dictionary_encode()
            lang_names, lang = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            p, p0 = shares(count, of), shares(np.zeros(len(of), np.int64), of)
            # entry i meets entries start[i] .. start[i] + length[i] - 1, its own term's
            length = np.repeat(np.diff(offs), np.diff(offs))
            start = np.repeat(offs[:-1], np.diff(offs))
            own_lang = np.repeat(lang, np.diff(offs))
            base = int(offs[0])
            code, p, p0 = code[base : offs[-1]], p[base : offs[-1]], p0[base : offs[-1]]
            start = start - base
            done = np.concatenate([[0], np.cumsum(length)])
            lo = 0
            while lo < len(length):
                hi = max(lo + 1, int(np.searchsorted(done, done[lo] + PAIR_STEP, side="right")) - 1)
                i = np.repeat(np.arange(lo, hi), length[lo:hi])
                j = np.arange(len(i)) - np.repeat(done[lo:hi] - done[lo], length[lo:hi]) + start[i]
                i, j = i[code[i] != code[j]], j[code[i] != code[j]]
                value = gaps(p[i], p[j]) - gaps(p[i], p0[j]) - gaps(p0[i], p[j]) + gaps(p0[i], p0[j])
                key = (own_lang[i] * len(names) + code[i]) * len(names) + code[j]
                each, at = np.unique(key, return_inverse=True)
                total = np.zeros(len(each), np.int64)
                np.add.at(total, at, value)
                for k, v in zip(each.tolist(), total.tolist(), strict=True):
                    name = (lang_names[k // len(names) ** 2], names[k // len(names) % len(names)], names[k % len(names)])
                    sums[name] = sums.get(name, 0) + v
                if len(sums) >= PAIR_ENTRIES:
                    yield emit()
                    sums = {}
                lo = hi
        if sums:
            yield emit()

    return postings.mapInArrow(run, "lang string, source string, item string, value long")


def audit(
    docs: DataFrame, least: int = 3, top: int = 200, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", block_entries: int = BLOCK_ENTRIES
) -> DataFrame:
    """(lang, source, part, item, value, rank): each group's distance to the language's other
    sources ('pair', all) and the terms it has more of than its language ('term', the ``top`` first)."""
    own = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    shards = parts_for(docs, 128 << 20)
    postings = stage(merge_runs(index_runs(own, shards, block_entries), shards, least), "term-postings")

    kept, present = postings.where(F.col("term") != ""), postings.where(F.col("term") == "")
    flat = kept.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "counts")).alias("e")).select(
        "lang", "term", "total", F.col("e.sources").alias("source"), F.col("e.counts").alias("c")
    )
    sizes = flat.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("all"))
    zero = F.lit(0).cast("long")
    groups = present.select("lang", F.explode("sources").alias("source")).join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("v", zero).alias("v"), (F.coalesce("n", zero) + F.coalesce("v", zero)).alias("of"), (F.coalesce("all", zero) + F.coalesce("v", zero)).alias("all_of"))
    groups = stage(groups.withColumn("p0", share(zero, F.col("of"))), "groups")
    counted = flat.join(groups, ["lang", "source"])

    # terms: more frequent in the group than in its language
    p, q = share(F.col("c"), F.col("of")), share(F.col("total"), F.col("all_of"))
    more = counted.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where(F.col("p") > F.col("q"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    best = more.select("lang", "source", "item", gap(F.col("p"), F.col("q")).alias("value"))
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # pairs: what no occurrence gives, and the corrections
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    met = groups.join(other, "lang").where(F.col("source") != F.col("item"))
    start = met.select("lang", "source", "item", (F.col("v") * gap(F.col("p0"), F.col("q0"))).alias("value"))
    by_count = counted.groupBy("lang", "source", "c", "of", "p0").agg(F.count(F.lit(1)).alias("terms"))
    by_count = by_count.select("lang", "source", "terms", "p0", share(F.col("c"), F.col("of")).alias("p"))
    single = by_count.join(other, "lang").where(F.col("source") != F.col("item"))
    forth = F.col("terms") * (gap(F.col("p"), F.col("q0")) - gap(F.col("p0"), F.col("q0")))
    back = F.col("terms") * (gap(F.col("q0"), F.col("p")) - gap(F.col("q0"), F.col("p0")))
    single = single.groupBy("lang", "source", "item").agg(F.sum(forth).alias("forth"), F.sum(back).alias("back"))
    single = single.select("lang", F.explode(F.array(
        F.struct("source", "item", F.col("forth").alias("value")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")),
    )).alias("e")).select("lang", "e.*")
    both = shared_corrections(counted.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "c", "of")).alias("held")).select("lang", "held"))
    pairs = start.unionByName(single).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    columns = ["lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(best.withColumn("part", F.lit("term")).select(*columns))
