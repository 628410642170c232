"""Repeated passages by super-k-mer partitioning.

A window is ``width`` consecutive words of one document. Its minimiser is the
smallest hash among its runs of ``gram`` words. Consecutive windows with the same
minimiser form a super-k-mer, which travels to the minimiser's bucket as one
packed string instead of as many windows. Equal windows have equal minimisers,
so they meet in one bucket, where the windows of strings that share a minimiser
with another string are sorted and told apart exactly, word for word. The first
document (smallest id) of each window keeps it; the others lose its words.

Before anything is shuffled, a task collapses equal packed strings of its rows:
only the one with the smallest id goes on, as the others are then known to be
repeats. So a passage that a third of all documents share arrives once per block
of rows, not once per document. Blocks of strings for one bucket are compressed.

A phrase that many documents hold amid different words gives as many different strings
with one minimiser, which would all meet in one bucket. Such hot minimisers (by reckoning
more than ``HOT_STRINGS`` different strings) are found beforehand from every ``SAMPLE``-th
document. Their strings are cut up into windows, equal ones collapse within the task, and
each window goes to the bucket of its own hash. Equal windows have equal minimisers and
equal hashes, so they meet in one bucket whichever minimisers are taken for hot: the sample
decides on the way only, never on the result.

Buckets (``BUCKETS_PER_PARTITION`` per shuffle partition) are worked off one after the
other; one holds its share of the strings and no minimiser's crowd. The repeats found then meet the texts, dealt by document and packed
the same way.

Edge cases: null or empty texts have no words; texts shorter than the window are
kept whole; rows with a null id can't be ordered, take no part and are kept
whole; repeated rows with the same id and text don't remove each other (no id
is smaller) and get the same result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textblock import U64, Spans, blocks, gram_hash, mix, ranges

WIDTH = 13
GRAM = 3
BUCKETS_PER_PARTITION = 4
#: Bytes of text that a task packs at once, and at a time within.
PACK_BYTES = 24 << 20
BLOCK_BYTES = 1 << 20

LEVEL = 6
#: Different strings of a minimiser from which on it is split, as reckoned from every SAMPLE-th document.
HOT_STRINGS = 1 << 15
SAMPLE = 64

_SENT = "part int, bucket int, body binary"
#: A super-k-mer on its way: minimiser, document, hash of its text, first word, windows, bytes.
_FIELDS = (("key", np.uint32), ("doc", np.int64), ("text", np.int32), ("at", np.int32), ("windows", np.int32), ("bytes", np.int32))
_CUT = np.dtype([("doc", "<i8"), ("text", "<i4"), ("at", "<i4"), ("words", "<i4")])
#: Bucket number of rows that hold repeats already found.
_FOUND = -1
#: Kinds of rows of the last shuffle, in the order in which a task reads them.
_CUTS, _TEXTS = 0, 1


def _normal(data: np.ndarray, offs: np.ndarray) -> Spans:
    """Words of the block, with one space after each."""
    raw = Spans(data, offs)
    if not len(raw):
        return raw
    length = raw.end - raw.begin
    keep = ranges(raw.begin, length + 1)
    packed = np.append(data, np.uint8(32))[np.minimum(keep, len(data))]
    end = np.cumsum(length + 1)
    packed[end - 1] = 32
    bounds = np.concatenate([[0], end])[raw.first]
    return Spans(packed, bounds)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def super_kmers(words: Spans, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of windows, minimiser) of each super-k-mer of the block."""
    none = np.zeros(0, np.int64)
    if len(words) < width:
        return none, none, np.zeros(0, U64)
    low = _sliding_min(gram_hash(words.hashes(), gram), width - gram + 1)
    at = np.flatnonzero(words.row[: len(low)] == words.row[width - 1 :])
    if not len(at):
        return none, none, np.zeros(0, U64)
    low = low[at]
    fresh = np.empty(len(at), bool)
    fresh[0] = True
    fresh[1:] = (low[1:] != low[:-1]) | (words.row[at[1:]] != words.row[at[:-1]])
    begin = np.flatnonzero(fresh)
    return at[begin], np.diff(np.append(begin, len(at))), low[begin]


def _pack(columns: list[np.ndarray], text: np.ndarray) -> bytes:
    """Super-k-mers of one bucket: columns (fields of little entropy compress well), then their strings."""
    raw = b"".join([len(columns[0]).to_bytes(8, "little"), *(c.tobytes() for c in columns), text.tobytes()])
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", LEVEL).compress(raw, asbytes=True)


def _unpack(body: bytes) -> bytes:
    return pa.Codec("zstd").decompress(body[8:], int.from_bytes(body[:8], "little"), asbytes=True)


class _Packer:
    """Super-k-mers of one task's rows, equal ones collapsed to the smallest id."""

    def __init__(self, width: int, gram: int, buckets: int, parts: int, hot: np.ndarray | None = None):
        self.width, self.gram, self.buckets, self.parts = width, gram, buckets, parts
        #: Minimisers whose strings go window by window.
        self.hot = np.zeros(0, U64) if hot is None else hot
        self.clear()

    def clear(self) -> None:
        self.raw: list[np.ndarray] = []
        self.runs: list[tuple[np.ndarray, ...]] = []
        self.size = self.bytes = 0

    def add(self, data: np.ndarray, offs: np.ndarray, doc: np.ndarray, text: np.ndarray) -> None:
        words = _normal(data, offs)
        first, windows, key = super_kmers(words, self.width, self.gram)
        self.size += len(data)
        if not len(first):
            return
        begin, end, row = words.begin[first], words.end[first + windows + self.width - 2], words.row[first]
        at = (first - words.first[row]).astype(np.int32)
        content = words.span_hash(begin, end)
        self.runs.append((key, content, doc[row], text[row], at, windows.astype(np.int32), begin + self.bytes, (end - begin).astype(np.int32)))
        self.raw.append(words.data)
        self.bytes += len(words.data)

    def _repeated(self, raw, key, content, doc, begin, size) -> tuple[np.ndarray, np.ndarray]:
        """(order, source): rows by key and content, smallest id first; source: the place of the equal string it repeats, or -1."""
        order = np.lexsort((doc, content, key))
        k, c, n = key[order], content[order], size[order]
        new = np.append(True, (k[1:] != k[:-1]) | (c[1:] != c[:-1]) | (n[1:] != n[:-1]))
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        again = np.flatnonzero(~new)
        source = np.full(len(order), -1, np.int64)
        if len(again):
            b, n = begin[order], n.astype(np.int64)
            differ = raw[ranges(b[again], n[again])] != raw[ranges(b[head[again]], n[again])]
            wrong = np.bincount(np.repeat(np.arange(len(again)), n[again])[differ], minlength=len(again)) > 0
            source[again[~wrong]] = head[again[~wrong]]
        return order, source

    def _collapsed(self, raw, key, content, doc, text, at, windows, begin, size) -> tuple[np.ndarray, np.ndarray]:
        """(rows that go on, rows known to be repeats)."""
        order, source = self._repeated(raw, key, content, doc, begin, size)
        has = source >= 0
        own, held = order[has], order[source[has]]
        repeat = doc[own] > doc[held]  # the same id again stays: both must hear of a smaller one
        twice = (doc[own] == doc[held]) & (text[own] == text[held]) & (at[own] == at[held])
        stay = np.ones(len(order), bool)
        stay[np.flatnonzero(has)[repeat | twice]] = False
        return order[stay], own[repeat]

    def _cut_up(self, raw, doc, text, at, windows, begin, size) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """(bytes, columns as in ``runs``): the windows of the strings, each with its own hash as its key."""
        length = size.astype(np.int64)
        words = Spans(raw[ranges(begin, length)], np.concatenate([[0], np.cumsum(length)]))
        many = windows.astype(np.int64)
        first = ranges(words.first[:-1], many)
        b, e = words.begin[first], words.end[first + self.width - 1]
        content, own = words.span_hash(b, e), np.repeat(np.arange(len(many)), many)
        place = (at[own] + first - words.first[own]).astype(np.int32)
        return words.data, (content, content, doc[own], text[own], place, np.ones(len(own), np.int32), b, (e - b).astype(np.int32))

    def strings(self) -> tuple[np.ndarray, np.ndarray]:
        """(minimiser, hash) of the different strings so far."""
        if not self.runs:
            return np.zeros(0, U64), np.zeros(0, U64)
        key, content = (np.concatenate([r[k] for r in self.runs]) for k in (0, 1))
        order = np.lexsort((content, key))
        key, content = key[order], content[order]
        new = np.append(True, (key[1:] != key[:-1]) | (content[1:] != content[:-1]))
        return key[new], content[new]

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.runs:
            return self.clear()
        raw = np.concatenate(self.raw)
        runs = tuple(np.concatenate(c) for c in zip(*self.runs, strict=True))
        self.clear()
        order, cut = self._collapsed(raw, *runs)
        crowd = np.isin(runs[0][order], self.hot)
        if crowd.any():
            more, split = self._cut_up(raw, *(c[order[crowd]] for c in runs[2:]))
            stay, again = self._collapsed(more, *split)
            order, cut = np.concatenate([order[~crowd], stay + len(runs[0])]), np.concatenate([cut, again + len(runs[0])])
            split = (*split[:6], split[6] + len(raw), split[7])
            runs, raw = tuple(np.concatenate(c) for c in zip(runs, split, strict=True)), np.concatenate([raw, more])
        key, _, doc, text, at, windows, begin, size = runs
        part, bucket, body = [], [], []
        to = ((key[order] >> U64(33)) % U64(self.buckets)).astype(np.int64)
        by = np.argsort(to, kind="stable")
        order, to = order[by], to[by]
        edges = np.flatnonzero(np.append(True, to[1:] != to[:-1])).tolist() + [len(to)]
        short = (key >> U64(32)).astype(np.uint32)
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            mine = order[lo:hi]
            columns = [short[mine], doc[mine], text[mine], at[mine], windows[mine], size[mine]]
            part.append(int(to[lo]) % self.parts)
            bucket.append(int(to[lo]))
            body.append(_pack(columns, raw[ranges(begin[mine], size[mine].astype(np.int64))]))
        if len(cut):
            side = (doc[cut].astype(U64) * U64(0x9E3779B97F4A7C15) >> U64(40)) % U64(self.parts)
            for p in np.unique(side).tolist():
                mine = cut[side == p]
                found = np.empty(len(mine), _CUT)
                found["doc"], found["text"], found["at"], found["words"] = doc[mine], text[mine], at[mine], windows[mine] + self.width - 1
                part.append(p)
                bucket.append(_FOUND)
                body.append(_pack([np.ascontiguousarray(found[c]) for c in _CUT.names], np.zeros(0, np.uint8)))
        yield pa.record_batch([pa.array(part, pa.int32()), pa.array(bucket, pa.int32()), pa.array(body, pa.binary())], ["part", "bucket", "body"])


def _columns(raw: bytes, kinds) -> tuple[list[np.ndarray], bytes]:
    n, at, out = int.from_bytes(raw[:8], "little"), 8, []
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out, raw[at:]


def _repeats(bodies: list[bytes], width: int) -> list[np.ndarray]:
    """The repeats (doc, text, at, words) among one bucket's super-k-mers."""
    parts = [_columns(raw, [k for _, k in _FIELDS]) for raw in bodies]
    key, doc, txt, at, _, size = (np.concatenate(c) for c in zip(*(p[0] for p in parts), strict=True))
    _, group, n = np.unique(key, return_inverse=True, return_counts=True)
    met = np.flatnonzero(n[group] > 1)
    text = b"".join([p[1] for p in parts])
    stop = np.cumsum(size.astype(np.int64))
    start = stop - size
    # equal strings of several blocks have equal windows: sort each string's windows once
    same: dict[bytes, list[int]] = {}
    for i, b, e in zip(met.tolist(), start[met].tolist(), stop[met].tolist(), strict=True):
        same.setdefault(text[b:e], []).append(i)
    window: list[tuple[bytes, int, int, int]] = []
    for j, (s, who) in enumerate(same.items()):
        low = min(doc[who].tolist()) if len(who) > 1 else int(doc[who[0]])
        edge = [0, *accumulate(len(w) + 1 for w in s.split(b" "))]
        window.extend((s[edge[k] : edge[k + width] - 1], low, j, k) for k in range(len(edge) - width))
    window.sort()
    last, low = None, 0
    places: list[list[tuple[int, int]]] = [[] for _ in same]
    for s, d, j, k in window:
        if s != last:
            last, low = s, d  # sorted: the smallest id comes first
        places[j].append((k, low))
    out = []
    for j, who in enumerate(same.values()):
        mine = sorted(places[j])
        for i in who:
            d = int(doc[i])
            covered = [k for k, m in mine if m < d]
            # neighbouring windows are one stretch
            for lo, hi in _runs(covered):
                out.append((d, int(txt[i]), int(at[i]) + lo, hi - lo + width))
    found = np.array(out, _CUT)
    return [np.ascontiguousarray(found[c]) for c in _CUT.names]


def _runs(places: list[int]) -> list[tuple[int, int]]:
    """(first, last) of each run of consecutive numbers of an ascending list."""
    out: list[tuple[int, int]] = []
    for k in places:
        if out and k == out[-1][1] + 1:
            out[-1] = (out[-1][0], k)
        else:
            out.append((k, k))
    return out


def _part_of(doc: np.ndarray, parts: int) -> np.ndarray:
    return (mix(doc.astype(np.int64).view(U64)) % U64(parts)).astype(np.int64)


def _by_part(to: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places) of each part that has any."""
    order = np.argsort(to, kind="stable")
    edges = np.flatnonzero(np.append(True, to[order][1:] != to[order][:-1])).tolist() + [len(to)] if len(to) else [0]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield int(to[order[lo]]), order[lo:hi]


def _batch(part: list[int], kind: list[int], body: list[bytes], second: str) -> pa.RecordBatch:
    return pa.record_batch([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(body, pa.binary())], ["part", second, "body"])


def _sent_cuts(cuts: list[np.ndarray], parts: int) -> pa.RecordBatch:
    rows = [(p, _pack([np.ascontiguousarray(c[own]) for c in cuts], np.zeros(0, np.uint8))) for p, own in _by_part(_part_of(cuts[0], parts))]
    return _batch([p for p, _ in rows], [_CUTS] * len(rows), [b for _, b in rows], "kind")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.hash(F.col(text_col)).alias("text_hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def hot_minimisers(rows: DataFrame, width: int, gram: int) -> np.ndarray:
    """Minimisers that by reckoning have more than HOT_STRINGS different strings in rows (doc, text_hash, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(width, gram, 1, 1)

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c.view(np.int64)) for c in packer.strings()]
            packer.clear()
            return pa.record_batch(columns, ["key", "content"])

        for batch in batches:
            doc, text = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, hi, data, offs in blocks(batch.column(2), BLOCK_BYTES):
                packer.add(data, offs, doc[lo:hi], text[lo:hi])
                if packer.size >= PACK_BYTES:
                    yield flush()
        yield flush()

    some = rows.where(F.pmod(F.xxhash64("doc", "text"), F.lit(SAMPLE)) == 0)
    strings = some.mapInArrow(run, "key long, content long")
    crowds = strings.groupBy("key").agg(F.count_distinct("content").alias("n")).where(F.col("n") * SAMPLE > HOT_STRINGS)
    return np.sort(np.array([r["key"] for r in crowds.select("key").collect()], np.int64).view(U64))


def _stretches(docs: DataFrame, width: int, gram: int, id_col: str, text_col: str, parts: int) -> DataFrame:
    """Packed repeats (part, kind, body), dealt by document."""
    buckets = parts * BUCKETS_PER_PARTITION
    rows = _rows(docs.where(F.col(id_col).isNotNull()), id_col, text_col)
    hot = hot_minimisers(rows, width, gram)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(width, gram, buckets, parts, hot)
        for batch in batches:
            doc, text = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, hi, data, offs in blocks(batch.column(2), BLOCK_BYTES):
                packer.add(data, offs, doc[lo:hi], text[lo:hi])
                if packer.size >= PACK_BYTES:
                    yield from packer.flush()
        yield from packer.flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for b, body in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = _unpack(body.as_py())
                if b == _FOUND:
                    yield _sent_cuts(_columns(raw, [_CUT[c] for c in _CUT.names])[0], parts)
                    continue
                if b != now:
                    if held:
                        yield _sent_cuts(_repeats(held, width), parts)
                    now, held = b, []
                held.append(raw)
        if held:
            yield _sent_cuts(_repeats(held, width), parts)

    sent = rows.mapInArrow(pack, _SENT).repartitionById(parts, F.col("part")).sortWithinPartitions("bucket")
    return sent.mapInArrow(count, "part int, kind int, body binary")


def _packed_texts(docs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """Texts (part, kind, body), dealt by document; each task's texts for one part travel compressed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            doc, null, text, size = (np.concatenate([h[k] for h in held]) for k in range(4))
            data = np.concatenate([h[4] for h in held])
            start = np.cumsum(size) - size
            rows = []
            for p, own in _by_part(_part_of(np.where(null, np.arange(len(doc)), doc), parts)):
                columns = [doc[own], null[own].astype(np.uint8), text[own], size[own].astype(np.int64)]
                rows.append((p, _pack(columns, data[ranges(start[own], size[own])])))
            held.clear()
            return _batch([p for p, _ in rows], [_TEXTS] * len(rows), [b for _, b in rows], "kind")

        for batch in batches:
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            doc, text = batch.column(0).fill_null(0).to_numpy(), batch.column(1).to_numpy()
            for lo, hi, data, offs in blocks(batch.column(2), BLOCK_BYTES):
                held.append((doc[lo:hi], null[lo:hi], text[lo:hi], np.diff(offs), data))
                if sum(len(h[4]) for h in held) >= PACK_BYTES:
                    yield flush()
        if held:
            yield flush()

    return _rows(docs, id_col, text_col).mapInArrow(run, "part int, kind int, body binary")


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Per document: id (as long), n_words, n_removed and ``kept`` (the words left, joined by one space).

    With ``digest`` the kept text is replaced by its SHA-256 (kept_sha256, lowercase hex).
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    name = "kept_sha256" if digest else "kept"

    def keep(columns: list[np.ndarray], data: np.ndarray, cuts: list[np.ndarray]) -> pa.RecordBatch:
        doc, null, text, size = columns
        words = _normal(data, np.concatenate([[0], np.cumsum(size)]))
        low, high = np.searchsorted(cuts[0], doc, "left"), np.searchsorted(cuts[0], doc, "right")
        n = np.where(null > 0, 0, high - low)
        at, owner = ranges(low, n), np.repeat(np.arange(len(doc)), n)
        mine = cuts[1][at] == text[owner]
        at, owner = at[mine], owner[mine]
        delta = np.zeros(len(words) + 1, np.int32)
        begin = words.first[owner] + cuts[2][at]
        np.add.at(delta, begin, 1)
        np.add.at(delta, begin + cuts[3][at], -1)
        stay = np.cumsum(delta[:-1]) == 0
        total = np.concatenate([[0], np.cumsum(stay)])
        length = (words.end - words.begin + 1)[stay]
        left = words.data[ranges(words.begin[stay], length)].tobytes()
        edge = np.concatenate([[0], np.cumsum(length)])[total[words.first]].tolist()
        texts = [left[b : max(b, e - 1)] for b, e in zip(edge[:-1], edge[1:], strict=True)]
        return pa.record_batch(
            [
                pa.array(doc, mask=null > 0),
                pa.array(words.counts),
                pa.array(words.counts - np.diff(total[words.first])),
                pa.array([hashlib.sha256(t).hexdigest() if digest else t.decode() for t in texts], pa.string()),
            ],
            [id_col, "n_words", "n_removed", name],
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[np.ndarray]] = []
        cuts = None
        for batch in batches:
            for kind, body in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                if kind == _CUTS:
                    found.append(_columns(_unpack(body.as_py()), [_CUT[c] for c in _CUT.names])[0])
                    continue
                if cuts is None:  # all of the partition's repeats come before its texts
                    cuts = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, _CUT[c]) for c in _CUT.names]
                    order = np.argsort(cuts[0], kind="stable")
                    cuts = [c[order] for c in cuts]
                columns, text = _columns(_unpack(body.as_py()), [np.int64, np.uint8, np.int32, np.int64])
                yield keep(columns, np.frombuffer(text, np.uint8), cuts)

    sent = _stretches(docs, width, gram, id_col, text_col, parts).union(_packed_texts(docs, id_col, text_col, parts))
    dealt = sent.repartitionById(parts, F.col("part")).sortWithinPartitions("kind")
    return dealt.mapInArrow(cut, f"`{id_col}` long, n_words long, n_removed long, {name} string")
