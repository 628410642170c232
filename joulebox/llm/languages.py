"""Language identification by a linear-chain conditional random field.

Words (runs of ASCII letters and of bytes beyond ASCII, A-Z in lower case) are the chain;
their languages are the labels. A word's score for a language is the sum of the
weights of its features: the word itself (lexicon), its first and last two and
three bytes (affixes), and its three-byte runs (n-grams), hashed to ``2 ** BITS``
slots. Learned transition weights join neighbours. Forward-backward gives each
word's probability of each language, so code-switched texts get their parts
labelled; a document's language is the one with the largest mean probability,
which is its score.

Forward-backward runs over all texts of a block at once: chains are cut into
segments of ``SEGMENT`` words, whose transfer matrices are multiplied side by
side, then joined along each chain, then opened up again. Features and scores are
worked out once for each distinct word of a block.

Training: about ``MAX_TRAINING_ROWS`` documents, in ``SHARDS`` shards by a hash of their
id. A shard's documents are laid end to end in short chains, so the chains change language
at known places and the transitions are learned from such changes. AdaGrad steps
on the likelihood; the shards' weights are averaged after each epoch.

Edge cases: texts that are null or have no letter are ``und`` with score 0; so is every text
if there is no labelled document. Ties go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import stage
from .textblock import LOWER, U64, Spans, blocks, ranges

BITS = 16
SHARDS = 8
EPOCHS = 3
CHAIN = 4
CHAINS = 4
RATE = 0.3
SEGMENT = 64
#: Bound on the documents that the model is fitted on.
MAX_TRAINING_ROWS = 4_000
#: Documents that a rare language gives at least, beyond that bound.
MIN_TRAINING_ROWS = 100
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[ord("A") : ord("Z") + 1] = 1
    t[ord("a") : ord("z") + 1] = 1
    t[0x80:] = 1
    return t


LETTERS = letter_table()


@dataclass
class Model:
    languages: list[str]
    #: (slots, languages), (languages, languages) by (from, to)
    weights: np.ndarray
    moves: np.ndarray


def word_slots(words: Spans, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, slot): the features of the words ``pick``; owner is the place in ``pick``."""
    begin, end = words.begin[pick], words.end[pick]
    size, mask = end - begin, U64((1 << BITS) - 1)
    own = np.arange(len(pick))
    owners, slots = [own], [words.span_hash(begin, end, 1)]
    for n in (2, 3):
        has = size >= n
        owners += [own[has], own[has]]
        slots += [words.span_hash(begin[has], begin[has] + n, 10 + n), words.span_hash(end[has] - n, end[has], 20 + n)]
    runs = np.maximum(0, size - 2)
    at = ranges(begin, runs)
    owners.append(np.repeat(own, runs))
    slots.append(words.span_hash(at, at + 3, 30))
    return np.concatenate(owners), (np.concatenate(slots) & mask).astype(np.int64)


def emissions(words: Spans, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """(scores of the distinct words, each word's place among them, their features)."""
    _, first, same = np.unique(words.hashes(), return_index=True, return_inverse=True)
    owner, slot = word_slots(words, first)
    k = weights.shape[1]
    e = np.empty((len(first), k))
    for j in range(k):
        e[:, j] = np.bincount(owner, weights=weights[slot, j], minlength=len(first))
    return e, same, (owner, slot)


def marginals(score: np.ndarray, first: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Each word's label probabilities. score: (words, labels); first: bounds of the chains; moves: (from, to)."""
    n, k = score.shape
    f = np.exp(score - score.max(axis=1, keepdims=True))
    a = np.exp(moves - moves.max())
    length = np.diff(first)
    chain = np.flatnonzero(length)
    pieces = -(-length[chain] // SEGMENT)
    head = np.concatenate([[0], np.cumsum(pieces)])
    seg_of = np.repeat(np.arange(len(chain)), pieces)
    nth = np.arange(head[-1]) - head[seg_of]
    begin = first[chain][seg_of] + nth * SEGMENT
    size = np.minimum(SEGMENT, first[chain][seg_of] + length[chain][seg_of] - begin)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))  # of a segment in the sorted order
    live = [int(np.searchsorted(-size, -t, side="left")) for t in range(SEGMENT + 1)]  # segments longer than t
    steps = int(size[0]) if len(size) else 0

    # a segment's transfer matrix: from the label before its first word to that of its last
    transfer = np.broadcast_to(np.eye(k), (len(begin), k, k)).copy()
    if len(begin) > len(chain):  # else no chain has two segments
        for t in range(steps):
            m = live[t]
            x = (transfer[:m].reshape(m * k, k) @ a).reshape(m, k, k)
            x *= f[begin[:m] + t][:, None, :]
            if t % 8 == 7:
                x /= x.max(axis=(1, 2), keepdims=True)
            transfer[:m] = x
        transfer /= transfer.max(axis=(1, 2), keepdims=True)

    # along each chain: what comes before and after each segment (before a chain's first word: all ones, no move)
    most = int(pieces.max()) if len(pieces) else 0
    before, after = np.ones((len(begin), k)), np.ones((len(begin), k))
    fresh = np.zeros(len(begin), bool)
    fresh[place[head[:-1]]] = True
    by_pieces = np.argsort(-pieces, kind="stable")
    more = [int(np.searchsorted(-pieces[by_pieces], -t, side="left")) for t in range(most + 1)]
    for t in range(1, most):
        own = by_pieces[: more[t]]
        at, was = place[head[own] + t], place[head[own] + t - 1]
        if t == 1:  # the first word of a chain has no move into it: open its segment from the inside
            v = _open_first(f, a, begin[was], size[was])
        else:
            v = np.einsum("ni,nij->nj", before[was], transfer[was])
        before[at] = v / v.sum(axis=1, keepdims=True)
    for t in range(most - 2, -1, -1):
        own = by_pieces[: more[t + 1]]
        at, then = place[head[own] + t], place[head[own] + t + 1]
        # the transfer of a segment begins with the move into it
        v = np.einsum("nij,nj->ni", transfer[then], after[then])
        after[at] = v / v.sum(axis=1, keepdims=True)

    # open the segments: forward, then backward
    out = np.empty((n, k))
    v = before.copy()
    for t in range(steps):
        m = live[t]
        x = v[:m] @ a
        if t == 0:
            x[fresh[:m]] = 1.0
        x *= f[begin[:m] + t]
        x /= x.sum(axis=1, keepdims=True)
        v[:m] = x
        out[begin[:m] + t] = x
    v = after.copy()
    for t in range(steps - 1, -1, -1):
        m = live[t]
        out[begin[:m] + t] *= v[:m]
        x = (v[:m] * f[begin[:m] + t]) @ a.T
        v[:m] = x / x.sum(axis=1, keepdims=True)
    out /= out.sum(axis=1, keepdims=True)
    return out


def _open_first(f: np.ndarray, a: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Forward vectors at the last words of full segments that begin chains."""
    v = f[begin]
    for t in range(1, int(size[0]) if len(size) else 0):
        v = (v @ a) * f[begin + t]
        v /= v.sum(axis=1, keepdims=True)
    return v


def pair_sums(score: np.ndarray, first: np.ndarray, moves: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Expected numbers of moves (from, to), from the words' marginals and the chain's local conditionals."""
    n, k = score.shape
    f = np.exp(score - score.max(axis=1, keepdims=True))
    a = np.exp(moves - moves.max())
    total = np.zeros((k, k))
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo < 2:
            continue
        # backward messages of one chain; training chains are few and short
        beta = np.ones((hi - lo, k))
        for t in range(hi - lo - 2, -1, -1):
            x = a @ (f[lo + t + 1] * beta[t + 1])
            beta[t] = x / x.sum()
        alpha = p[lo:hi] / beta
        q = alpha[:-1, :, None] * a[None] * (f[lo + 1 : hi] * beta[1:])[:, None, :]
        total += (q / q.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return total


def train(rows: DataFrame, languages: list[str], epochs: int = EPOCHS) -> Model:
    """Fit to stored rows (shard, place, y, text); y is the place in ``languages``."""
    k, slots = len(languages), 1 << BITS
    weights, moves = np.zeros((slots, k), np.float32), np.zeros((k, k))
    sums, move_sums = np.zeros((slots, k), np.float32), np.zeros((k, k))

    def epoch(w0, m0, s0, ms0):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            w, m, s, ms = w0.astype(np.float64), m0.copy(), s0.astype(np.float64), ms0.copy()
            pdf = pdf.sort_values(["place", "y"], kind="stable")
            for lo in range(0, len(pdf), CHAIN * CHAINS):
                part = pdf.iloc[lo : lo + CHAIN * CHAINS]
                raw = [t.encode() for t in part["text"]]
                offs = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
                words = Spans(np.frombuffer(b"".join(raw), np.uint8), offs, LETTERS, LOWER)
                if not len(words):
                    continue
                e, same, (owner, slot) = emissions(words, w)
                score = e[same]
                gold = part["y"].to_numpy()[words.row]
                first = words.first[np.append(np.arange(0, len(part), CHAIN), len(part))]
                p = marginals(score, first, m)
                expected = pair_sums(score, first, m, p)
                inside = np.ones(len(words), bool)
                inside[first[:-1][np.diff(first) > 0]] = False
                here = np.flatnonzero(inside)
                seen = np.zeros((k, k))
                np.add.at(seen, (gold[here - 1], gold[here]), 1)
                p[np.arange(len(p)), gold] -= 1
                used, at = np.unique(slot, return_inverse=True)
                g = np.empty((len(used), k))
                for j in range(k):
                    mine = np.bincount(same, weights=p[:, j], minlength=len(e))
                    g[:, j] = np.bincount(at, weights=mine[owner], minlength=len(used))
                g += 1e-3 * w[used]
                s[used] += g * g
                w[used] -= RATE * g / (np.sqrt(s[used]) + 1e-6)
                gm = expected - seen + 1e-2 * m
                ms += gm * gm
                m -= RATE * gm / (np.sqrt(ms) + 1e-6)
            return pd.DataFrame({"w": [w.astype(np.float32).tobytes()], "m": [m.tobytes()], "s": [s.astype(np.float32).tobytes()], "ms": [ms.tobytes()]})

        return run

    def mean(got, name: str, kind, like: np.ndarray) -> np.ndarray:
        return np.mean([np.frombuffer(r[name], kind) for r in got], axis=0, dtype=np.float64).reshape(like.shape).astype(like.dtype)

    for _ in range(epochs):
        got = rows.groupBy("shard").applyInPandas(epoch(weights, moves, sums, move_sums), "w binary, m binary, s binary, ms binary").collect()
        weights, moves = mean(got, "w", np.float32, weights), mean(got, "m", np.float64, moves)
        sums, move_sums = mean(got, "s", np.float32, sums), mean(got, "ms", np.float64, move_sums)
    return Model(languages, weights, moves)


def fit(
    docs: DataFrame, allowed, max_rows: int = MAX_TRAINING_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    min_rows: int = MIN_TRAINING_ROWS,
) -> Model | None:
    """A model from the texts and languages of the ids that ``allowed`` admits; None if there are none.

    About ``max_rows`` rows are taken by a hash of the id, and of each language about ``min_rows`` at least (all, if it has fewer).
    """
    known = docs.where(allowed & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    counts = known.groupBy(lang_col).count().collect()
    n = sum(r["count"] for r in counts)
    if not n:
        return None
    languages = sorted(r[lang_col] for r in counts)
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), F.lit(1 << 20))
    shares = [min(1 << 20, (max(min_rows, max_rows * r["count"] // n) << 20) // r["count"]) for r in counts]
    share = F.element_at(F.create_map(*[F.lit(x) for r, s in zip(counts, shares, strict=True) for x in (r[lang_col], s)]), F.col(lang_col))
    chosen = known.where(place < share)
    y = F.array_position(F.lit(languages), F.col(lang_col)) - 1
    spread = F.xxhash64(F.col(id_col), F.lit(19))
    rows = chosen.select(
        F.pmod(spread, F.lit(SHARDS)).cast("int").alias("shard"), spread.alias("place"), y.cast("int").alias("y"), F.col(text_col).alias("text")
    )
    return train(stage(rows, "language-rows"), languages)


def document_languages(words: Spans, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the language, its mean probability, the mean of the words' own best probabilities) of each row.

    Rows without words have -1 and 0. A text of several languages has a low probability of each and certain words.
    """
    rows = words.rows
    k = len(model.languages)
    pred, score, sure = np.full(rows, -1), np.zeros(rows), np.zeros(rows)
    if not len(words):
        return pred, score, sure
    e, same, _ = emissions(words, model.weights)
    p = marginals(e[same], words.first, model.moves)
    sums = np.empty((rows, k))
    for j in range(k):
        sums[:, j] = np.bincount(words.row, weights=p[:, j], minlength=rows)
    full = words.counts > 0
    pred[full] = sums[full].argmax(axis=1)
    score[full] = np.minimum(1.0, sums[full].max(axis=1) / words.counts[full])
    sure[full] = np.minimum(1.0, np.bincount(words.row, weights=p.max(axis=1), minlength=rows)[full] / words.counts[full])
    return pred, score, sure


def word_languages(text: str, model: Model) -> list[tuple[str, str, float]]:
    """(word, language, probability) along one text: for looking at code-switched texts."""
    raw = text.encode()
    words = Spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), LETTERS, LOWER)
    if not len(words):
        return []
    e, same, _ = emissions(words, model.weights)
    p = marginals(e[same], words.first, model.moves)
    best = p.argmax(axis=1)
    return [
        (raw[b:e_].decode("utf-8", "replace"), model.languages[j], float(p[i, j]))
        for i, (b, e_, j) in enumerate(zip(words.begin.tolist(), words.end.tolist(), best.tolist(), strict=True))
    ]


def has_letter(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"\p{L}")


def identify(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
    pred_col: str = "lang_pred", score_col: str = "score", sure_col: str | None = None,
) -> DataFrame:
    """``keep`` columns (the id only, if not given), the language and the score of every row, and how sure its words are
    where ``sure_col`` is given. Without a model every language is unknown."""
    keep = keep or [id_col]
    clash = {pred_col, score_col, sure_col} & set(keep)
    if clash:
        raise ValueError(f"the kept columns include {sorted(clash)}; name the results otherwise")
    if model is None:
        none = [F.lit(0.0).alias(c) for c in (score_col, sure_col) if c]
        return docs.select(*keep, F.lit(UNKNOWN).alias(pred_col), *none)
    names = np.array([*model.languages, UNKNOWN], object)
    numbers = [c for c in (score_col, sure_col) if c]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(pred_col, T.StringType())] + [T.StructField(c, T.DoubleType()) for c in numbers])
    sent = [F.col(c) for c in keep]
    if text_col not in keep:
        sent.append(F.col(text_col))
    where, n = keep.index(text_col) if text_col in keep else len(keep), len(sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letter = batch.column(n).to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi, data, offs in blocks(batch.column(where)):
                pred, score, sure = document_languages(Spans(data, offs, LETTERS, LOWER), model)
                none = ~letter[lo:hi] | (pred < 0)
                pred[none], score[none], sure[none] = len(names) - 1, 0.0, 0.0
                own = [batch.column(i).slice(lo, hi - lo) for i in range(len(keep))]
                yield pa.record_batch([*own, pa.array(names[pred], pa.string()), pa.array(score), pa.array(sure)][: len(schema)], schema.fieldNames())

    return docs.select(*sent, has_letter(F.col(text_col)).alias("__letter")).mapInArrow(run, schema)
