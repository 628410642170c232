"""Stable row numbering over a total order without a single-partition window.

The frame is range-partitioned and sorted on the order keys; each row gets
its partition id and in-partition position; that tagging is frozen by
writing it once as parquet under ``spark.checkpoint.dir`` (columnar, lineage
cut) so retries and lost executors see the same numbering; per-partition
counts (one row per partition, a bounded table) give each partition's offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joulebox.session import stage_table


#: Stored bytes of the tables read that one partition of a shuffle should stand for: rows take many times as much unpacked.
PARTITION_BYTES = 16 << 20


#: Spark gives frames of unknown size (rows handed over by the driver) a size beyond any real table.
UNKNOWN_BYTES = 1 << 53


def partitions_for(df: DataFrame) -> int:
    """Partitions for what the frame reads; 1 where that has no known size.

    The sizes are those of the plan's sources: the optimizer takes a join to be as large as its sides multiplied.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return max(1, sum(s for s in sizes if s < UNKNOWN_BYTES) // PARTITION_BYTES)


def global_index(df: DataFrame, order: list[Column | str], index_col: str = "row_index", partitions: int | None = None) -> DataFrame:
    """0-based position of every row in ``order`` (make it a total order for a deterministic result).

    Identical rows are spread over partitions by a seeded tie-breaker, so a
    value that repeats a third of all rows does not land in one task.
    """
    spark = df.sparkSession
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions_for(df))
    keys = [F.col(c) if isinstance(c, str) else c for c in order] + [F.rand(17)]
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    tagged = ranged.withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()})
    tagged = stage_table(tagged, "row-index")
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    out = tagged.join(F.broadcast(offsets.select("_pid", "_offset", "_first")), "_pid")
    return out.withColumn(index_col, F.col("_offset") + F.col("_mid") - F.col("_first")).drop("_pid", "_mid", "_offset", "_first")
