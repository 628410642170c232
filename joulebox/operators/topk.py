"""Ordered limits. ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject:
each task keeps its k best rows, so no full sort and no big shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top_k(df: DataFrame, order: list[Column], k: int, tie_break: list[str] | None = None) -> DataFrame:
    """First k rows by ``order``; remaining output columns break ties (deterministic)."""
    keys = list(order) + [df[c].asc_nulls_first() for c in (tie_break if tie_break is not None else df.columns)]
    return df.orderBy(*keys).limit(k)
