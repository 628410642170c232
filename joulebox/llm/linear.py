"""Hashed features and logistic regression with follow-the-regularised-leader updates.

The model is ``2 ** bits`` weights and a bias, whatever the data. Training rows are
bounded by a parameter and dealt to ``SHARDS`` shards by a hash of their id. In each
epoch every shard's task starts from the common state (z, n), goes through its
rows in small batches with FTRL-Proximal updates, and returns how far it moved the state; the
common state becomes the mean. The state is a stored table between epochs. So training is a few short Spark jobs with a
result that does not depend on how rows lie in files or on the number of executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stage
from .textblock import blocks, list_column

SHARDS = 8
BATCH = 32

#: features(data, offs) -> (row, slot, value, bias row scale): occurrences, sorted by row.
Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, allowed, max_rows: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Texts and labels (doc, text, y) of about ``max_rows`` labelled rows, all if there are fewer.

    ``allowed`` is a condition on the id: no other row's label is read. Rows are chosen
    by a hash of the id. The chosen ids are broadcast: ``max_rows`` bounds them.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & allowed)
        .groupBy(F.col(id_col).alias("doc"))
        .agg(F.max(F.col(label).cast("double")).alias("y"))
    )
    n = known.count()
    part = F.pmod(F.xxhash64("doc", F.lit(7)), F.lit(1 << 20))
    chosen = known.where(part < F.lit(min(1 << 20, (max_rows << 20) // max(1, n))))
    texts = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc")


def distinct_features(row: np.ndarray, slot: np.ndarray, value: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values summed by row and slot, in order."""
    key, back = np.unique(row.astype(np.int64) << bits | slot, return_inverse=True)
    return key >> bits, key & ((1 << bits) - 1), np.bincount(back, weights=value, minlength=len(key))


def featurise(rows: DataFrame, features: Features, bits: int) -> DataFrame:
    """Stored training data of rows (doc, y, text), packed by shard."""
    keep = ["doc", "y"]
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(len(keep))
            for lo, hi, data, offs in blocks(text):
                row, slot, value = distinct_features(*features(data, offs), bits)
                counts = np.bincount(row, minlength=hi - lo)
                yield pa.record_batch(
                    [
                        *[batch.column(i).slice(lo, hi - lo) for i in range(len(keep))],
                        list_column(slot.astype(np.int32), counts, pa.int32()),
                        list_column(value.astype(np.float32), counts, pa.float32()),
                    ],
                    [*keep, "slots", "weights"],
                )

    made = rows.select(*keep, "text").mapInArrow(run, f"{schema}, slots array<int>, weights array<float>")
    place = F.xxhash64("doc", F.lit(11))
    return stage(pack_shards(made.withColumn("place", place).withColumn("shard", F.pmod("place", F.lit(SHARDS)).cast("int"))), "training-shards")


def pack_shards(rows: DataFrame) -> DataFrame:
    """One row per shard of rows (shard, place, y, slots, weights): its labels, slot counts, slots and values as binary, in order.

    The training rows are bounded, and so is a shard. Epochs read the packed shards without shuffling them again.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["place", "y"], kind="stable")
        slots = pdf["slots"].tolist()
        body = {
            "y": pdf["y"].to_numpy(np.float64),
            "counts": np.array([len(x) for x in slots], np.int64),
            "slots": np.concatenate([*slots, []]).astype(np.int32),
            "weights": np.concatenate([*pdf["weights"].tolist(), []]).astype(np.float32),
        }
        return pd.DataFrame({"model": [0], "shard": [int(pdf["shard"].iloc[0])], **{c: [v.tobytes()] for c, v in body.items()}})

    return rows.select("shard", "place", "y", "slots", "weights").groupBy("shard").applyInPandas(run, "model int, shard int, y binary, counts binary, slots binary, weights binary")


def ftrl_weights(z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float | np.ndarray, l2: float) -> np.ndarray:
    w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
    w[np.abs(z) <= l1] = 0
    return w


#: The common state: the slots that any row has had, in order, and their z and n. At most 2 ** bits slots.
_STATE = "model int, at binary, z binary, n binary"


def _slots(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(raw or b"", np.int32)


def _numbers(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(raw or b"", np.float32)


def _common(moved: DataFrame, state: DataFrame, shards: int) -> DataFrame:
    """The state after an epoch: the mean of the shards', which ``moved`` says how far they went (model, shard, at, dz, dn).

    A shard without a slot's rows leaves it as it is.
    """

    def merge(moved: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        moved = moved.sort_values("shard")
        known = _slots(before["at"].iloc[0]) if len(before) else _slots(None)
        every = np.unique(np.concatenate([known, *map(_slots, moved["at"])]))
        z, n = np.zeros((2, len(every)))
        if len(before):
            place = np.searchsorted(every, known)
            z[place], n[place] = _numbers(before["z"].iloc[0]), _numbers(before["n"].iloc[0])
        for at, dz, dn in zip(moved["at"], moved["dz"], moved["dn"], strict=True):
            place = np.searchsorted(every, _slots(at))
            z[place] += _numbers(dz) / shards
            n[place] += _numbers(dn) / shards
        return pd.DataFrame({"model": [0], "at": [every.tobytes()], "z": [z.astype(np.float32).tobytes()], "n": [n.astype(np.float32).tobytes()]})

    return stage(moved.groupBy("model").cogroup(state.groupBy("model")).applyInPandas(merge, _STATE), "ftrl-state")


def train_ftrl(
    rows: DataFrame, bits: int, epochs: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5,
    free: np.ndarray | None = None,
) -> np.ndarray:
    """Weights (2 ** bits and the bias last) from packed shards; labels may be probabilities. ``free``: slots without L1.

    The state is a stored table of one row, which is broadcast to the shards (2 ** bits slots of 12 bytes bound it); a shard
    returns how far it moved the slots of its own rows. The driver gets the weights that are not 0, once.
    """
    size = (1 << bits) + 1

    def penalty(slot: np.ndarray) -> np.ndarray:
        return np.where(np.isin(slot, free), 0.0, l1) if free is not None else np.full(len(slot), l1)

    def one(r) -> dict[str, bytes | int]:  # noqa: ANN001
        y, counts, slots, weights = np.frombuffer(r.y), np.frombuffer(r.counts, np.int64), _slots(r.slots), _numbers(r.weights)
        own_slots = np.unique(np.append(slots, np.int32(size - 1)))
        z0, n0 = np.zeros((2, len(own_slots)))
        known = _slots(r.at)
        if len(known):
            place = np.minimum(np.searchsorted(known, own_slots), len(known) - 1)
            met = known[place] == own_slots
            z0[met], n0[met] = _numbers(r.z)[place[met]], _numbers(r.n)[place[met]]
        z, n, least = z0.copy(), n0.copy(), penalty(own_slots)
        slots = np.searchsorted(own_slots, slots)
        edge = np.concatenate([[0], np.cumsum(counts)])
        for lo in range(0, len(y), BATCH):
            hi = min(len(y), lo + BATCH)
            here = slice(edge[lo], edge[hi])
            own = np.concatenate([np.repeat(np.arange(hi - lo), counts[lo:hi]), np.arange(hi - lo)])
            slot = np.concatenate([slots[here], np.full(hi - lo, len(own_slots) - 1)])
            x = np.concatenate([weights[here], np.ones(hi - lo)])
            used, at = np.unique(slot, return_inverse=True)
            w = ftrl_weights(z[used], n[used], alpha, beta, least[used], l2)
            p = 1 / (1 + np.exp(-np.clip(np.bincount(own, weights=w[at] * x, minlength=hi - lo), -30, 30)))
            g = np.bincount(at, weights=(p - y[lo:hi])[own] * x, minlength=len(used))
            z[used] += g - (np.sqrt(n[used] + g * g) - np.sqrt(n[used])) / alpha * w
            n[used] += g * g
        moved = [v.astype(np.float32).tobytes() for v in (z - z0, n - n0)]
        return {"model": 0, "shard": r.shard, "at": own_slots.astype(np.int32).tobytes(), "dz": moved[0], "dn": moved[1]}

    def epoch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for r in pdf.itertuples():
                yield pd.DataFrame([one(r)])

    def weigh(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for r in pdf.itertuples():
                at = _slots(r.at)
                w = ftrl_weights(_numbers(r.z).astype(np.float64), _numbers(r.n).astype(np.float64), alpha, beta, penalty(at), l2)
                yield pd.DataFrame([{"at": at[w != 0].tobytes(), "w": w[w != 0].tobytes()}])

    out = np.zeros(size)
    shards = rows.count()
    if not shards:
        return out
    state = rows.sparkSession.createDataFrame([], _STATE)
    for _ in range(epochs):
        moved = rows.join(F.broadcast(state), "model", "left").mapInPandas(epoch, "model int, shard int, at binary, dz binary, dn binary")
        state = _common(moved, state, shards)
    for r in state.mapInPandas(weigh, "at binary, w binary").collect():
        out[_slots(r["at"])] = np.frombuffer(r["w"])
    return out


def score(docs: DataFrame, features: Features, w: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(id, score) of every row: the logistic function of a sparse dot product."""
    kind = docs.schema[id_col].dataType.simpleString()
    weights, bias = w[:-1].astype(np.float32), float(w[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in blocks(batch.column(1)):
                row, slot, value = features(data, offs)
                total = bias + np.bincount(row, weights=weights[slot] * value, minlength=hi - lo)
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(1 / (1 + np.exp(-np.clip(total, -30, 30))))], [id_col, "score"])

    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"{id_col} {kind}, score double")
