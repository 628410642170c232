"""Quality scores: hashed word n-grams, logistic regression, FTRL updates.

Tokens are runs of letters and digits (ASCII ones, and all bytes beyond ASCII) and runs of
other visible characters. Features are tokens, pairs of tokens, and whether a
word is the same as the one or two before it; each counts with its share of
the text's tokens times ``SCALE``. All of a text is read.

Edge cases: null and empty texts have no features and get the model's bias; if there are no labelled rows
at all, every score is 0.5. Labels that contradict each other for one id count as 1.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .linear import featurise, labelled_sample, score, train_ftrl
from .textblock import U64, Spans, mix

BITS = 18
SCALE = 10.0
EPOCHS = 6
#: Bound on the labelled rows that the model is fitted on.
MAX_TRAINING_ROWS = 12_000


def token_table() -> np.ndarray:
    """Byte classes: 0 space and control, 1 letters, digits and beyond ASCII, 2 other visible characters."""
    t = np.full(256, 2, np.uint8)
    t[:0x21] = 0
    t[0x7F] = 0
    for a, b in (("0", "9"), ("A", "Z"), ("a", "z")):
        t[ord(a) : ord(b) + 1] = 1
    t[0x80:] = 1
    return t


TOKENS = token_table()


def features(data: np.ndarray, offs: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of all n-gram occurrences of a block."""
    t = Spans(data, offs, TOKENS)
    h, mask = t.hashes(), U64((1 << bits) - 1)
    pair = mix(h[:-1] * U64(0x9E3779B97F4A7C15) + h[1:]) if len(h) else h
    together = np.flatnonzero(t.row[1:] == t.row[:-1])
    words = np.flatnonzero(t.kind == 1)
    hw, rw = h[words], t.row[words]
    rows, slots = [t.row, t.row[together]], [h & mask, pair[together] & mask]
    for back in (1, 2):
        same = np.flatnonzero((hw[back:] == hw[:-back]) & (rw[back:] == rw[:-back])) + back
        rows.append(rw[same])
        slots.append(np.full(len(same), back, U64))
    row, slot = np.concatenate(rows), np.concatenate(slots).astype(np.int64)
    return row, slot, SCALE / np.maximum(1, t.counts)[row]


def fit(
    docs: DataFrame, labels: DataFrame, allowed, max_rows: int = MAX_TRAINING_ROWS, label: str = "quality", id_col: str = "doc_id", text_col: str = "text"
) -> np.ndarray:
    """Weights from the labels of the ids that ``allowed`` admits."""
    rows = featurise(labelled_sample(docs, labels, label, allowed, max_rows, id_col, text_col), features, BITS)
    return train_ftrl(rows, BITS, EPOCHS)


def quality_scores(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row, score in 0 to 1."""
    return score(docs, features, weights, id_col, text_col)
