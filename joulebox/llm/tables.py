"""Reading the driver tables and staging intermediate ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulebox.session import stage_table as stage  # noqa: F401


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Spark gives frames of unknown size (rows handed over by the driver) a size beyond any real table.
_UNKNOWN_BYTES = 1 << 53


def parts_for(df: DataFrame, bytes_each: int) -> int:
    """Partitions for a shuffle of ``df``: the session's number, more where the optimizer's size of it asks for more."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // bytes_each if size < _UNKNOWN_BYTES else 0)


def held_out(doc_id, modulus: int, remainder: int):
    """The contract's split: crc32 of the id as text, modulo ``modulus``, is ``remainder``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))
