"""URL allow and block lists by a Bloom filter cascade.

The cascade's first level is a Bloom filter of the listed keys. The next one
holds the keys of the corpus that the first takes for listed though they are
not, the third those listed keys that the second takes for false positives, and
so on until no key is left. A key of the corpus is listed if and only if the
number of levels that it passes before the first miss is odd; so membership is
exact for every key of the corpus, though each level is only a Bloom filter.
The levels' sizes follow the list and the false positives of the level before,
not the corpus; they travel as literals (about 1.44 bits a listed key for each halving of the error rate). Building it joins the
list with the keys that pass the first level only; judging joins nothing.

A rule is (host, path): it fits its host and all subdomains when the url's path
starts with the rule's. The keys of a url are the joined host endings and path
starts of the shapes that rules have (numbers of labels, lengths of paths), so
a url has as many keys as there are shapes and its length does not matter.

Edge cases: a null url, or one without ``://``, has an empty host and path and
meets no rule; repeated rows are judged alike; an empty table gives an empty
result; extra columns are left out of the result of ``judge``. If two listed
keys of one url are equally long, the one with the longer host wins.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bits
from .tables import stage

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Level:
    words: list[int]
    n_bits: int
    n_hashes: int


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, SMALL)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Keys (host ending joined with path start), longest first; of equal length the longer host first."""
    parts = F.size(F.split(host, r"\."))

    def key(n: Column, m: Column) -> Column:
        ending = F.call_function("substring_index", host, F.lit("."), -n)
        fits = (host != "") & (parts >= n) & (F.char_length(path) >= m)
        size = F.char_length(ending)
        return F.when(fits, F.struct((-size - m).alias("order"), (-size).alias("then"), F.concat(ending, F.substring(path, 1, m)).alias("key")))

    shapes = F.flatten(F.transform(F.lit(labels), lambda n: F.transform(F.lit(lengths), lambda m: key(n, m))))
    return F.transform(F.array_sort(F.array_compact(shapes)), lambda k: k["key"])


def build_cascade(listed: DataFrame, universe: DataFrame, max_levels: int = 64) -> list[Level]:
    """Levels for the keys ``listed`` (column key) over the distinct keys of ``universe`` (column key).

    The first level's error rate is the list's share of the universe, so about as many
    keys as are listed pass it wrongly; every later level errs at one half.
    """
    inside, outside = stage(listed.select("key").where("key is not null").distinct(), "listed-keys"), universe.select("key")
    n_in, n_out = inside.count(), outside.count()
    levels: list[Level] = []
    while n_in and len(levels) < max_levels:
        rate = 0.5 if levels else min(0.5, max(1e-9, n_in * math.sqrt(0.5) / max(1, n_out)))
        n_hashes = max(1, round(math.log2(1 / rate)))
        n_bits = max(64, math.ceil(n_in * n_hashes / math.log(2)))
        at = len(levels)
        level = Level(bits.fill(inside, F.col("key"), at, n_bits, n_hashes), n_bits, n_hashes)
        levels.append(level)
        wrong = outside.where(bits.holds(level.words, F.col("key"), at, n_bits, n_hashes))
        if at == 0:  # the few of the universe that pass are the listed ones and those that pass wrongly
            wrong = wrong.join(inside, "key", "left_anti")
        wrong = stage(wrong, f"cascade-{at}")
        # the next level holds what passed wrongly; what is in this one must then be told from it
        inside, outside, n_in = wrong, inside, wrong.count()
    if n_in:
        raise ValueError(f"the cascade did not end within {max_levels} levels")
    return levels


def listed(levels: list[Level], key: Column) -> Column:
    """Exact membership of a key of the universe."""
    out = F.lit(bool(len(levels) % 2))
    for at in reversed(range(len(levels))):
        x = levels[at]
        out = F.when(bits.holds(x.words, key, at, x.n_bits, x.n_hashes), out).otherwise(F.lit(bool(at % 2)))
    return out


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Verdict of each page: (id, host, path, rule, verdict).

    ``rules`` are (verdict, host, path) with verdict block or allow; the longest
    fitting one (host and path together) wins, and pages with none get ``default``.
    """
    spark = pages.sparkSession
    urls = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    if not rules:
        return urls.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    labels = sorted({len(h.split(".")) for _, h, _ in rules})
    lengths = sorted({len(p) for _, _, p in rules})
    keyed = urls.withColumn("keys", url_keys(F.col("host"), F.col("path"), labels, lengths))
    universe = stage(keyed.select(F.explode("keys").alias("key")).distinct(), "url-keys")
    member = {}
    for verdict in ("block", "allow"):
        own = F.from_json(F.lit(json.dumps([h + p for v, h, p in rules if v == verdict])), "array<string>")
        member[verdict] = build_cascade(spark.range(1).select(F.explode(own).alias("key")), universe)
    def longest(verdict: str) -> Column:
        return F.get(F.filter(F.col("keys"), lambda k: listed(member[verdict], k)), F.lit(0))

    out = keyed.withColumn("blocked", longest("block")).withColumn("allowed", longest("allow"))
    allow_wins = F.col("allowed").isNotNull() & (
        F.col("blocked").isNull() | (F.array_position("keys", F.col("allowed")) <= F.array_position("keys", F.col("blocked")))
    )
    return out.select(
        id_col,
        "host",
        "path",
        F.when(allow_wins, F.col("allowed")).otherwise(F.col("blocked")).alias("rule"),
        F.when(allow_wins, F.lit("allow")).when(F.col("blocked").isNotNull(), F.lit("block")).otherwise(F.lit(default)).alias("verdict"),
    )
