"""SentencePiece unigram encoding and decoding.

Pieces sit in a double-array trie over their bytes (base, check and piece per
state). A text is marked up as SentencePiece does: a leading whitespace marker
(U+2581) and a marker for each space. Viterbi's best path is the segmentation of the
highest sum of log scores; characters no piece covers cost ``UNKNOWN_PENALTY`` below the
lowest score and are written as byte pieces. Among equal sums the path met first,
by start, stays.

No piece has a marker after another character, so no path crosses from
a character into a marker: the text falls into segments (markers, then a word)
that are best cut one by one. A block's distinct segments run through the trie
and through Viterbi side by side, as numpy arrays; equal segments share the result.

The vocabulary file is a parameter. Scores: a BPE file holds merge ranks rather
than log scores; ``scores="zipf"`` gives rank r of n the log score -ln(r) - ln(H(n)),
``scores="file"`` takes the file's own numbers.

Decoding joins the pieces, turns byte pieces into bytes and markers into
spaces, and drops the leading one. U+2581 in a text is encoded as a space is, as SentencePiece
does, and decodes to a space; all other texts return exactly. Ids that are
not in the vocabulary, and control pieces, decode to nothing; bytes that are not
UTF-8 decode to U+FFFD.

Edge cases: null encodes and decodes to null, an empty text to no pieces;
very long texts and words are handled whole; extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .textblock import Spans, blocks, bytes_column, list_column, ranges

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
UNKNOWN_PENALTY = 10.0
BLOCK_BYTES = 1 << 20
#: Positions of distinct segments that go through the trie side by side.
TRIE_POSITIONS = 1 << 18


@dataclass
class Vocabulary:
    """What tasks need: the trie, scores by id, byte ids, and the bytes of each id."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    score: np.ndarray
    byte_ids: np.ndarray
    unknown_score: np.float32
    unknown_id: int
    letters: np.ndarray
    letter_offs: np.ndarray
    depth: int


def double_array(keys: list[bytes], values: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of a trie: from state s byte c leads to base[s] + c if check there is s."""
    children: list[dict[int, int]] = [{}]
    ends: list[int] = [-1]
    for key, v in zip(keys, values, strict=True):
        node = 0
        for c in key:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                ends.append(-1)
            node = children[node][c]
        ends[node] = v
    size = 2 * len(children) + 1024
    base, check, value = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int32)
    check[0] = 0
    free = 1  # all states below are taken
    todo = [(0, 0)]
    value[0] = ends[0]
    while todo:
        node, state = todo.pop()
        own = children[node]
        if not own:
            continue
        letters = np.array(sorted(own))
        while free < len(check) and check[free] >= 0:
            free += 1
        at = max(1, free - int(letters[0]))
        tries = 0
        while True:
            while at + 256 >= len(check):
                grow = len(check)
                base = np.concatenate([base, np.zeros(grow, np.int64)])
                check = np.concatenate([check, np.full(grow, -1, np.int64)])
                value = np.concatenate([value, np.full(grow, -1, np.int32)])
            if (check[at + letters] < 0).all():
                break
            tries += 1
            at += 1
        if tries > 64:  # keep the search short in crowded parts
            free = max(free, at - 128)
        base[state] = at
        check[at + letters] = state
        for c, n in own.items():
            value[at + c] = ends[n]
            todo.append((n, at + c))
    top = int(np.flatnonzero(check >= 0).max()) + 257
    base.resize(top, refcheck=False)
    out = np.full(top, -1, np.int64), np.full(top, -1, np.int32)
    n = min(top, len(check))
    out[0][:n], out[1][:n] = check[:n], value[:n]
    return base.astype(np.int32), out[0].astype(np.int32), out[1]


def load_vocabulary(path: str, scores: str = "zipf") -> Vocabulary:
    """Reads a SentencePiece model file on the driver (some MB, whatever the data)."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    normal = [i for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
    names = [m.id_to_piece(i) for i in range(n)]
    if scores == "zipf":
        rank = np.arange(1, len(normal) + 1)
        own = -np.log(rank) - np.log((1 / rank).sum())
    else:
        own = np.array([m.get_score(i) for i in normal])
    score = np.zeros(n, np.float32)
    score[normal] = own
    byte_ids = np.full(256, m.unk_id(), np.int32)
    letters = [b""] * n
    for i in range(n):
        if m.is_byte(i):
            byte_ids[int(names[i][3:5], 16)] = i
            letters[i] = bytes([int(names[i][3:5], 16)])
    keys = [names[i].encode() for i in normal]
    for i, k in zip(normal, keys, strict=True):
        if MARK in k.lstrip(MARK):
            raise ValueError(f"piece {i} has a whitespace marker after another character")
        letters[i] = k.replace(MARK, b" ")
    return build_vocabulary(keys, normal, score, byte_ids, m.unk_id(), letters)


def build_vocabulary(keys: list[bytes], ids: list[int], score: np.ndarray, byte_ids: np.ndarray, unknown_id: int, letters: list[bytes]) -> Vocabulary:
    base, check, value = double_array(keys, ids)
    return Vocabulary(
        base, check, value, score, byte_ids,
        np.float32(score[ids].min() - UNKNOWN_PENALTY), unknown_id,
        np.frombuffer(b"".join(letters), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in letters])]).astype(np.int64),
        max(map(len, keys)),
    )


def _marked(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block with a marker before each row that isn't empty, and for each space."""
    n = len(data)
    size = np.ones(n, np.int64)
    size[data == 32] = 3
    head = np.where(np.diff(offs) > 0, 3, 0)
    lead = np.zeros(n, np.int64)
    lead[offs[:-1][head > 0]] = 3
    end = np.cumsum(size + lead)
    out = np.empty(int(end[-1]) if n else 0, np.uint8)
    plain = size == 1
    out[end[plain] - 1] = data[plain]
    for at in (end[~plain], (end - size)[lead > 0]):
        for k in range(3):
            out[at - 3 + k] = MARK[k]
    bounds = np.concatenate([[0], end])[offs]
    return out, bounds


def _segments(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where segments begin: at rows' starts, and at markers that follow another character."""
    n = len(data)
    mark = np.zeros(n, bool)
    if n >= 3:
        mark[:-2] = (data[:-2] == MARK[0]) & (data[1:-1] == MARK[1]) & (data[2:] == MARK[2])
    after = np.zeros(n, bool)
    after[3:] = mark[:-3]
    begin = mark & ~after
    begin[offs[:-1][np.diff(offs) > 0]] = True
    return np.flatnonzero(begin)


def _edges(data: np.ndarray, end: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, piece) of all pieces in the bytes; end: of each byte's segment."""
    starts, stops, pieces = [], [], []
    at = np.flatnonzero((data & 0xC0) != 0x80)  # pieces begin at characters
    state = np.zeros(len(at), np.int32)
    begin, last = at, end[at]
    while len(at):
        to = v.base[state] + data[at]
        on = v.check[to] == state
        on &= (v.base[state] > 0)
        begin, last, at, state = begin[on], last[on], at[on] + 1, to[on]
        hit = v.value[state]
        found = hit >= 0
        starts.append(begin[found])
        stops.append(at[found])
        pieces.append(hit[found])
        more = at < last
        begin, last, at, state = begin[more], last[more], at[more], state[more]
    return np.concatenate(starts or [at]), np.concatenate(stops or [at]), np.concatenate(pieces or [state])


def _viterbi(data: np.ndarray, seg: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each segment's best path, joined, and how many. seg: bounds of the segments, len + 1."""
    n = len(data)
    length = np.diff(seg)
    end = np.repeat(seg[1:], length)
    start, stop, piece = _edges(data, end, v)
    score = v.score[piece]
    # a character without a piece of its own gets an edge as unknown
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    next_head = np.append(heads[1:], n)
    next_head = np.minimum(next_head, end[heads])
    alone = np.zeros(n + 1, bool)
    width = np.zeros(n, np.int64)
    width[heads] = next_head - heads
    alone[start[stop - start == width[start]]] = True
    bare = heads[~alone[heads]]
    start = np.concatenate([start, bare])
    stop = np.concatenate([stop, bare + width[bare]])
    piece = np.concatenate([piece, np.full(len(bare), -1, np.int32)])
    score = np.concatenate([score, np.full(len(bare), v.unknown_score, np.float32)])
    # positions of nodes: segment k has length[k] + 1 of them
    shift = np.repeat(np.arange(len(length)), length)
    inside = start - np.repeat(seg[:-1], length)[start]
    # the edges of one start position within its segment are relaxed together; each has its own target
    order = np.argsort(inside.astype(np.uint16) if len(inside) and inside.max() < 1 << 16 else inside, kind="stable")
    start, stop, piece, score, inside = start[order], stop[order], piece[order], score[order], inside[order]
    a, b = start + shift[start], stop + shift[start]
    best = np.full(n + len(length), -np.inf, np.float32)
    best[seg[:-1] + np.arange(len(length))] = 0
    back = np.full(n + len(length), -1, np.int64)
    cut = np.flatnonzero(np.append(True, inside[1:] != inside[:-1])).tolist() + [len(inside)] if len(inside) else [0]
    for lo, hi in zip(cut[:-1], cut[1:], strict=True):
        to = b[lo:hi]
        total = best[a[lo:hi]] + score[lo:hi]
        better = total > best[to]
        best[to[better]] = total[better]
        back[to[better]] = np.arange(lo, hi)[better]
    # walk all paths back together
    node = seg[1:] + np.arange(len(length))
    root = seg[:-1] + np.arange(len(length))
    owner = np.arange(len(length))
    steps = []
    live = node > root
    node, owner = node[live], owner[live]
    while len(node):
        edge = back[node]
        steps.append((owner, edge))
        node = a[edge]
        live = node > root[owner]
        node, owner = node[live], owner[live]
    if not steps:
        return np.zeros(0, np.int32), np.zeros(len(length), np.int64)
    # the k-th step back of a segment is its k-th edge from the end
    count = np.bincount(np.concatenate([s[0] for s in steps]), minlength=len(length))
    slot = np.cumsum(count) - 1
    which = np.empty(int(count.sum()), np.int64)
    for k, (own, edge) in enumerate(steps):
        which[slot[own] - k] = edge
    who = np.repeat(np.arange(len(length)), count)
    # unknown characters become byte pieces
    unit = piece[which]
    span = np.where(unit < 0, stop[which] - start[which], 1)
    if (unit >= 0).all():
        return unit, count
    ids = np.repeat(unit, span)
    raw = np.repeat(unit < 0, span)
    ids[raw] = v.byte_ids[data[ranges(start[which][unit < 0], span[unit < 0])]]
    return ids, np.bincount(who, weights=span, minlength=len(length)).astype(np.int64)


def _distinct(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the first of each different segment, which of them each is), by the segments themselves."""
    known: dict[bytes, int] = {}
    same = np.array([known.setdefault(text[b:e].tobytes(), len(known)) for b, e in zip(begin.tolist(), end.tolist(), strict=True)], np.int64)
    return np.unique(same, return_index=True)[1], same


def encode_block(data: np.ndarray, offs: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows joined, number of ids by row) of a block of texts."""
    text, bounds = _marked(data, offs)
    rows = len(offs) - 1
    if not len(text):
        return np.zeros(0, np.int32), np.zeros(rows, np.int64)
    begin = _segments(text, bounds)
    end = np.append(begin[1:], len(text))
    length = end - begin
    h = Spans(text, np.array([0, len(text)])).span_hash(begin, end)
    _, first, same = np.unique(h, return_index=True, return_inverse=True)
    model = first[same]  # each segment's first one of its hash: it must have the same bytes
    if not (np.array_equal(length[model], length) and np.array_equal(text[ranges(begin[model], length)], text)):
        first, same = _distinct(text, begin, end)
    ids, counts = [], []
    size = np.cumsum(length[first])
    lo = 0
    while lo < len(first):
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + TRIE_POSITIONS, side="right")))
        own = first[lo:hi]
        part = text[ranges(begin[own], length[own])]
        i, c = _viterbi(part, np.concatenate([[0], np.cumsum(length[own])]), v)
        ids.append(i)
        counts.append(c)
        lo = hi
    pool, count = np.concatenate(ids), np.concatenate(counts)
    offset = np.concatenate([[0], np.cumsum(count)])
    per = count[same]
    out = pool[ranges(offset[same], per)]
    row = np.searchsorted(bounds, begin, side="right") - 1
    return out, np.bincount(row, weights=per, minlength=rows).astype(np.int64)


def decode_block(ids: np.ndarray, counts: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the rows' texts; the leading space is dropped."""
    ids = np.where((ids >= 0) & (ids < len(v.letter_offs) - 1), ids, v.unknown_id)
    at = v.letter_offs[ids]
    size = v.letter_offs[ids + 1] - at
    out = v.letters[ranges(at, size)]
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
    full = ends[1:] > ends[:-1]
    lead = np.zeros(len(counts), np.int64)
    lead[full] = out[ends[:-1][full]] == 32
    if lead.any():
        stay = np.ones(len(out), bool)
        stay[ends[:-1][lead > 0]] = False
        out = out[stay]
    return out, ends - np.concatenate([[0], np.cumsum(lead)])


def _null_mask(col: pa.Array) -> np.ndarray:
    return col.is_null().to_numpy(zero_copy_only=False)


def _with_nulls(col: pa.Array, null: np.ndarray) -> pa.Array:
    return pc.if_else(pa.array(~null), col, pa.scalar(None, col.type)) if null.any() else col


def encode(df: DataFrame, v: Vocabulary, text_col: str = "text", out_col: str = "ids", check_col: str | None = None, drop_text: bool = False) -> DataFrame:
    """``df`` with an array column of piece ids; null texts get null.

    ``check_col`` adds whether the ids decode to the very text.
    """
    clash = {out_col, check_col} & set(df.columns)
    if clash:
        raise ValueError(f"the table already has columns {sorted(clash)}; name others")
    names = [c for c in df.columns if not (drop_text and c == text_col)]
    where = df.columns.index(text_col)
    index = [df.columns.index(c) for c in names]
    fields = [df.schema[i] for i in index] + [T.StructField(out_col, T.ArrayType(T.IntegerType(), False))]
    if check_col:
        fields.append(T.StructField(check_col, T.BooleanType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(where)
            null = _null_mask(col)
            for lo, hi, data, offs in blocks(col, BLOCK_BYTES):
                ids, counts = encode_block(data, offs, v)
                out = [batch.column(i).slice(lo, hi - lo) for i in index]
                out.append(_with_nulls(list_column(ids, counts, pa.int32()), null[lo:hi]))
                if check_col:
                    back, ends = decode_block(ids, counts, v)
                    out.append(_with_nulls(pa.array(_equal_rows(data, offs, back, ends)), null[lo:hi]))
                yield pa.record_batch(out, [f.name for f in fields])

    return df.mapInArrow(run, T.StructType(fields))


def _equal_rows(a: np.ndarray, a_offs: np.ndarray, b: np.ndarray, b_offs: np.ndarray) -> np.ndarray:
    rows = len(a_offs) - 1
    same = np.diff(a_offs) == np.diff(b_offs)
    size = np.where(same, np.diff(a_offs), 0)
    off = a[ranges(a_offs[:-1], size)] != b[ranges(b_offs[:-1], size)]
    bad = np.bincount(np.repeat(np.arange(rows), size)[off], minlength=rows) > 0
    return same & ~bad


def decode(df: DataFrame, v: Vocabulary, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``df`` with the text of its ids; null ids give null."""
    if out_col in df.columns:
        raise ValueError(f"the table already has a column {out_col}; name another")
    where = df.columns.index(ids_col)
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(where)
            null = _null_mask(col)
            counts = np.where(null, 0, col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
            flat = col.flatten().fill_null(v.unknown_id).to_numpy(zero_copy_only=False)
            data, offs = decode_block(flat, counts, v)
            text = bytes_column(data, offs, pa.binary())
            try:
                text = text.cast(pa.string())
            except pa.ArrowInvalid:
                text = pa.array([x.decode("utf-8", "replace") for x in text.to_pylist()], pa.string())
            yield pa.record_batch([*batch.columns, _with_nulls(text, null)], [*batch.schema.names, out_col])

    return df.mapInArrow(run, schema)
