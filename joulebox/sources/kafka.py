"""Kafka topic of JSON readings.

No Kafka connector jar ships in this environment, so ``kafka_stream`` is only
exercised where the ``spark-sql-kafka`` package is on the classpath. The JSON
decode is separate so it can be tested on any string column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    starting_offsets: str = "earliest",
) -> DataFrame:
    """readStream over a topic from the earliest offset; offsets live in the query checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load()


def decode_json(value: Column | str, schema: T.StructType | T.DataType | str) -> Column:
    """UTF-8 JSON bytes or text -> struct; malformed text gives NULL fields."""
    c = F.col(value) if isinstance(value, str) else value
    return F.from_json(c.cast("string"), schema, {"allowNonNumericNumbers": "true"})


def decode_values(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Kafka rows -> one column per schema field."""
    return df.select(decode_json(value_col, schema).alias("_r")).select("_r.*")
