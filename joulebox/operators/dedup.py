"""Duplicate removal.

Both forms are aggregations, so Spark combines duplicates map-side before the
shuffle: a key that holds a third of all rows costs one partial row per task,
not one task holding a third of the data (which a row_number window would).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joulebox.operators.indexing import partitions_for


def aggregate_dealt(df: DataFrame, keys: list[str], partial: Column, final: Column, partitions: int | None = None) -> DataFrame:
    """``keys`` and an aggregate of each group, which ``final`` makes of the ``partial`` ones.

    ``partial`` and ``final`` have the same name. Equal to ``df.groupBy(*keys).agg(partial)``, which it is while
    the session's partitions are enough for the tables read (``partitions`` unless given).
    """
    n = partitions or partitions_for(df)
    if n <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.groupBy(*keys).agg(partial)
    dealt = df.withColumns({"_hash": F.xxhash64(*keys), "_from": F.spark_partition_id()}).repartition(n, "_hash", "_from")
    partials = dealt.groupBy("_hash", "_from", *keys).agg(partial).repartition(n, "_hash")
    return partials.groupBy("_hash", *keys).agg(final).drop("_hash")


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row duplicate removal."""
    return df.dropDuplicates()


def dedup_rows_counted(df: DataFrame, count_col: str = "_copies") -> DataFrame:
    """Distinct rows with their multiplicity (feeds the one-pass stage report)."""
    return aggregate_dealt(df, df.columns, F.count(F.lit(1)).alias(count_col), F.sum(count_col).alias(count_col))


def dedup_key(df: DataFrame, key: str | list[str]) -> DataFrame:
    """One row per key, deterministically: the smallest remaining row.

    Rows are ordered by the non-key columns in column order, NULLs first
    (Spark struct ordering). ``dropDuplicates([key])`` keeps an arbitrary row;
    this keeps the same row on every run and every partitioning.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    picked = aggregate_dealt(df, keys, F.min(F.struct(*rest)).alias("_row"), F.min("_row").alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
