"""Join helpers. The planner picks the strategy from file statistics; nothing is broadcast by hint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_keys(fact: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """fact LEFT JOIN dim USING (on): fetch surrogate keys by natural value.

    The planner broadcasts the dimension while its files are under the broadcast
    threshold (read it from stored files, which have real statistics) and
    sorts and merges beyond it; AQE splits a natural value that many rows share.
    """
    return fact.join(dim, on=on, how="left")


def new_keys(batch: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing`` (NULL keys never match)."""
    return batch.join(existing.select(key).distinct(), on=key, how="left_anti")


def lookup_with_default(
    left: DataFrame, right: DataFrame, on: str, defaults: dict[str, object]
) -> DataFrame:
    """left LEFT JOIN right, then coalesce the right-side columns to defaults."""
    joined = left.join(right, on=on, how="left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
