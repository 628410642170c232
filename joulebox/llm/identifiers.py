"""Personal data: base patterns, and contexts bootstrapped from them.

Base spans are what four fixed patterns find (e-mail addresses, IP addresses,
payment cards, phone numbers). They are the seeds. A candidate is a stretch of
tokens with at least three digits or an ``@``. The words around a
candidate give its lexical patterns: the two words before, the two after, and one of
each. Patterns and the identifiers (texts of candidates) they surround form a
graph, which Spark scores in rounds:

- a pattern's confidence for a kind is the score that its distinct identifiers have for
  that kind, over one more than what they have for all kinds and what speaks against it; it counts if at least
  ``LEAST_SUPPORT`` of them score well and the confidence is at least ``LEAST_CONFIDENCE``;
- only a pattern in which seeds are ``SEED_SHARE`` of the identifiers is telling and can count;
- what speaks against a pattern is its identifiers that are no seeds, each by how plain its shape (digits
  and runs of letters) is: the share of their patterns, on average over the shape's identifiers, that are not telling. So an unseen
  form of a kind hardly counts against the contexts it is found in, and a year or an amount does;
- an identifier that is no seed, and has at most ``MOST_APART`` of its patterns outside the telling ones, scores 1 less the
  product of (1 - confidence) over the patterns that count.

What scores at least ``LEAST_SCORE`` after ``ROUNDS`` rounds is taken as the kind, wherever
it occurs. Identifiers count once for a pattern, so a passage that is copied ten
thousand times has no more weight than one, and a pattern that surrounds everything
has no confidence. Every step is a grouped sum with partial aggregation.

Positions are code points, ends are exclusive. Spans of a kind don't overlap.

Edge cases: a null text is empty and has no spans; rows are judged one by one, so repeated rows
get the same result; extra columns are ignored. Base patterns run in time
linear in the text, so very long texts are scanned whole. An empty table gives an empty result, and a table without
seeds the base spans alone (none).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stage
from .textblock import blocks

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
LEAST_SUPPORT = 5
LEAST_CONFIDENCE = 0.8
LEAST_SCORE = 0.9
MOST_APART = 0.5
SEED_SHARE = 0.2
BLOCK_BYTES = 1 << 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match within a run of digits always begins where the run does
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CANDIDATE = re.compile(r"(?:(?<=\s)|^)\S*[0-9@]\S*(?: [+(]?[0-9]\S*)*")
_WORD = re.compile(r"[^\W\d_]+")
_EDGES = ".,;:!?\"'()[]{}<>|"
#: Characters around a candidate that its words are looked for in.
_NEAR = 64


def _emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append((begin, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) of the base patterns' matches, by kind and start."""
    out = [(0, *s) for s in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def _patterns(text: str, start: int, end: int) -> list[str]:
    before = [w.lower() for w in _WORD.findall(text[max(0, start - _NEAR) : start])[-2:]]
    after = [w.lower() for w in _WORD.findall(text[end : end + _NEAR])[:2]]
    out = []
    if len(before) == 2:
        out.append(f"{before[0]} {before[1]} _")
    if len(after) == 2:
        out.append(f"_ {after[0]} {after[1]}")
    if before and after:
        out.append(f"{before[-1]} _ {after[0]}")
    return out


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, list[str]]]:
    """(kind or -1, start, end, identifier, patterns): the base spans, and other candidates that touch none."""
    out = [(k, b, e, text[b:e], _patterns(text, b, e)) for k, b, e in base]
    taken = sorted((b, e) for _, b, e in base)
    i = 0
    for m in _CANDIDATE.finditer(text):
        begin, end = m.start(), m.end()
        while begin < end and text[begin] in _EDGES:
            begin += 1
        while end > begin and text[end - 1] in _EDGES:
            end -= 1
        while i < len(taken) and taken[i][1] <= begin:
            i += 1
        own = text[begin:end]
        if (i == len(taken) or taken[i][0] >= end) and ("@" in own or sum(c in "0123456789" for c in own) >= 3):
            out.append((-1, begin, end, own, _patterns(text, begin, end)))
    return out


_FOUND = "array<struct<kind:int,start:int,end:int,identifier:string,patterns:array<string>>>"
_ARROW = pa.list_(
    pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("identifier", pa.string()), ("patterns", pa.list_(pa.string()))])
)


def find(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """One stored row per document: row, ``keep`` columns, found (its base spans and candidates)."""
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in blocks(batch.column(n), BLOCK_BYTES):
                # only texts with a digit or an @ can have any
                hit = np.concatenate([[0], np.cumsum((data == 64) | ((data >= 48) & (data <= 57)))])
                some = hit[offs[1:]] > hit[offs[:-1]]
                found: list[list] = [[] for _ in range(hi - lo)]
                for i in np.flatnonzero(some).tolist():
                    text = data[offs[i] : offs[i + 1]].tobytes().decode("utf-8", "replace")
                    found[i] = [
                        {"kind": k, "start": b, "end": e, "identifier": s, "patterns": p} for k, b, e, s, p in occurrences(text, base_spans(text))
                    ]
                yield pa.record_batch([*[batch.column(i).slice(lo, hi - lo) for i in range(n)], pa.array(found, _ARROW)], [*keep, "found"])

    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    made = rows.mapInArrow(run, f"{schema}, found {_FOUND}")
    return stage(made.withColumn("row", F.monotonically_increasing_id()), "identifiers")


def shape(identifier):
    """Digits as 0, one by one, and runs of letters as a."""
    return F.regexp_replace(F.regexp_replace(identifier, "[0-9]", "0"), r"\p{L}+", "a")


def discover(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(identifier, kind): identifiers beyond the seeds that confident patterns surround."""
    each = found.select(F.explode("found").alias("o")).select("o.kind", "o.identifier", F.explode("o.patterns").alias("pattern"))
    edges = stage(each.groupBy("pattern", "identifier").agg(F.max("kind").alias("kind")), "pattern-identifiers")
    seeds = edges.where("kind >= 0").select("identifier", "kind", F.lit(1.0).alias("score")).distinct()
    total = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") >= 0).alias("seeds"))
    total = stage(total.withColumn("telling", F.col("seeds") >= F.col("n") * SEED_SHARE), "patterns")
    # identifiers that are no seeds: the share of their patterns that are not telling, and the mean of it for their shape
    free = edges.join(total, "pattern").groupBy("identifier").agg(F.max("kind").alias("kind"), F.avg((~F.col("telling")).cast("double")).alias("apart")).where("kind < 0")
    free = free.select("identifier", "apart", shape(F.col("identifier")).alias("shape"))
    shapes = free.groupBy("shape").agg(F.avg("apart").alias("neutral"))
    free = stage(free.where("apart < 1").join(shapes, "shape").select("identifier", "apart", "neutral"), "free-identifiers")
    against = edges.select("pattern", "identifier").join(free, "identifier").groupBy("pattern").agg(F.sum("neutral").alias("against"))
    trusted = total.where((F.col("n") >= LEAST_SUPPORT) & F.col("telling")).select("pattern")
    against = stage(trusted.join(against, "pattern", "left").select("pattern", F.coalesce("against", F.lit(0.0)).alias("against")), "contrary")
    near = edges.select("pattern", "identifier").join(against.select("pattern"), "pattern", "left_semi")
    scores, known = seeds, None
    for _ in range(rounds):
        mass = near.join(scores, "identifier").groupBy("pattern", "kind").agg(F.sum("score").alias("mass"), F.sum((F.col("score") >= 0.5).cast("int")).alias("support"))
        mass = stage(mass, "pattern-mass")
        every = mass.groupBy("pattern").agg(F.sum("mass").alias("every"))
        sure = mass.join(every, "pattern").join(against, "pattern")  # what is of other kinds speaks against, what is unknown and of no plain shape doesn't
        sure = sure.withColumn("confidence", F.col("mass") / (F.col("every") + F.col("against") + 1))
        sure = sure.where((F.col("support") >= LEAST_SUPPORT) & (F.col("confidence") >= LEAST_CONFIDENCE))
        doubt = F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))
        known = near.join(sure, "pattern").groupBy("identifier", "kind").agg((1 - F.exp(F.sum(doubt))).alias("score"))
        known = stage(known.join(free.where(F.col("apart") <= MOST_APART).select("identifier"), "identifier", "left_semi"), "identifier-scores")
        if known.isEmpty():
            break
        scores = seeds.union(known.select("identifier", "kind", "score"))
    best = known.groupBy("identifier").agg(F.max(F.struct("score", -F.col("kind"))).alias("b"))
    return best.where(F.col("b.score") >= LEAST_SCORE).select("identifier", (-F.col("b.col2")).cast("int").alias("kind"))


def spans(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Per row: ``keep`` columns, base and spans (arrays of (kind, start, end), by kind and start)."""
    found = find(docs, keep, text_col)
    new = discover(found)
    loose = found.select("row", F.explode("found").alias("o")).where("o.kind < 0").select("row", "o.identifier", "o.start", "o.end")
    added = loose.join(new, "identifier").groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    base = F.transform(
        F.filter("found", lambda o: o["kind"] >= 0),
        lambda o: F.struct(o["kind"].alias("kind"), o["start"].alias("start"), o["end"].alias("end")),
    )
    own = found.select("row", *keep, F.array_sort(base).alias("base")).join(added, "row", "left")
    every = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    return own.select(*keep, "base", every.alias("spans"))


def span_text(column: str):
    """``kind:start:end`` of each span, comma-joined."""
    names = F.lit(list(KINDS))
    return F.array_join(
        F.transform(column, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count_of(column: str, kind: str):
    return F.size(F.filter(column, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by its kind in angle brackets; no row is dropped."""
    key = {"__id": F.col(id_col), "__hash": F.xxhash64(F.col(text_col))}
    marked = spans(docs.withColumns(key).select("__id", "__hash", text_col), ["__id", "__hash"], text_col)
    marked = marked.where(F.size("spans") > 0).select("__id", "__hash", "spans").dropDuplicates(["__id", "__hash"])
    names = docs.columns
    here = docs.withColumns(key)
    on = here["__id"].eqNullSafe(marked["__id"]) & (here["__hash"] == marked["__hash"])
    joined = here.join(marked, on, "left").select(*[here[c] for c in names], marked["spans"])
    at = names.index(text_col)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col, found = batch.column(at), batch.column(len(names))
            rows = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
            if len(rows):
                texts = col.to_pylist()
                for i in rows.tolist():
                    texts[i] = _blank(texts[i], found[i].as_py())
                col = pa.array(texts, col.type)
            yield pa.record_batch([*batch.columns[:at], col, *batch.columns[at + 1 : len(names)]], names)

    return joined.mapInArrow(run, schema)


def _blank(text: str, found: list[dict]) -> str:
    out, free = [], 0
    for s in sorted(found, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= free:
            out += [text[free : s["start"]], f"<{KINDS[s['kind']]}>"]
        free = max(free, s["end"])
    return "".join([*out, text[free:]])
