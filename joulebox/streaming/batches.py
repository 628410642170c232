"""Stamp readings with record ids and fixed-size batch ids (the batch splitter, as a Spark job)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joulebox.functions.text import batch_id, record_id
from joulebox.operators.indexing import global_index


def stamp_batches(
    df: DataFrame,
    order: list[Column | str],
    batch_size: int = 50,
    source: str = "power_consumption_sensor",
    ingested_at: str | None = None,
) -> DataFrame:
    """RecordID = REC-%06d of the 0-based position in ``order``; batch_id =
    POWER-BATCH-%04d of position // batch_size + 1; constant source and ingest time."""
    indexed = global_index(df, order, "_row")
    stamp = F.lit(ingested_at) if ingested_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return indexed.select(
        record_id("_row").alias("RecordID"),
        *[c for c in df.columns],
        F.lit(source).alias("source"),
        stamp.alias("ingested_at"),
        batch_id(F.floor(F.col("_row") / batch_size) + 1).alias("batch_id"),
    )
