"""Bit arrays and Bloom probes made of SQL expressions only.

A bit array is a list of 64-bit words that a query carries as a literal. Its
length is fixed by the caller, so what reaches every task has a known size. The literal is one
text that the optimizer turns into an array once, so a plan with millions of words is built at once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def positions(key: Column, salt: int, n_bits: int, n_hashes: int) -> list[Column]:
    """Bit positions of ``key``: double hashing from two seeded 64-bit hashes."""
    h1 = F.xxhash64(key, F.lit(2 * salt + 1))
    if n_hashes == 1:
        return [F.pmod(h1, F.lit(n_bits))]
    h2 = F.pmod(F.xxhash64(F.lit(2 * salt + 2), key), F.lit(n_bits)) * 2 + 1
    first = F.pmod(h1, F.lit(n_bits))
    return [F.pmod(first + F.lit(j) * h2, F.lit(n_bits)) for j in range(n_hashes)]


def fill(keys: DataFrame, key: Column, salt: int, n_bits: int, n_hashes: int) -> list[int]:
    """The bit array of all ``keys``; at most n_bits / 64 words reach the driver."""
    bit = keys.select(F.explode(F.array(*positions(key, salt, n_bits, n_hashes))).alias("b"))
    words = bit.groupBy(F.expr("b div 64").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("v")
    )
    out = [0] * max(1, math.ceil(n_bits / 64))
    for r in words.collect():
        out[r["w"]] = r["v"]
    return out


def holds(words: list[int], key: Column, salt: int, n_bits: int, n_hashes: int) -> Column:
    """Whether all bits of ``key`` are set."""
    if not any(words):
        return F.lit(False)
    table = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")
    test = F.lit(True)
    for p in positions(key, salt, n_bits, n_hashes):
        word = F.get(table, F.shiftright(p, 6).cast("int"))
        test = test & (F.call_function("getbit", word, (p % 64).cast("int")) == 1)
    return test
