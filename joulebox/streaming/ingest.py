"""Landing-zone files (or a Kafka topic) -> raw parquet layer, incrementally.

Replaces the poll-buffer-write loop of the original collector: the source
offsets and the sink's file log live in the checkpoint, so a restart neither
re-numbers nor overwrites earlier output and each input file is written
exactly once; ``availableNow`` drains what is there and stops; micro-batches are bounded by
bytes where asked for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from joulebox.sources.files import CORRUPT_COLUMN
from joulebox.sources.kafka import decode_values, kafka_stream
from joulebox.sources.topic import topic_stream


def file_stream(
    spark: SparkSession, landing: str, schema: T.StructType, max_bytes_per_trigger: str | None = None, fmt: str = "json", keep_corrupt: bool = False
) -> DataFrame:
    """Stream of a folder's files; a micro-batch takes all new files, or about ``max_bytes_per_trigger`` (e.g. "500g").

    With ``keep_corrupt`` a line that is not JSON keeps its text in the corrupt-record column, which
    ``split_corrupt`` tells apart when the raw layer is read; without it such a line is a row of NULLs.
    """
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    reader = spark.readStream.format(fmt).schema(schema).option("allowNonNumericNumbers", "true").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(landing)


def write_raw(stream: DataFrame, target: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()


def ingest_files(
    spark: SparkSession, landing: str, schema: T.StructType, target: str, checkpoint: str,
    max_bytes_per_trigger: str | None = None, keep_corrupt: bool = False,
) -> StreamingQuery:
    """Drain the landing folder into ``target`` and wait for it (availableNow)."""
    q = write_raw(file_stream(spark, landing, schema, max_bytes_per_trigger, keep_corrupt=keep_corrupt), target, checkpoint)
    q.awaitTermination()
    return q


def epoch_folder(target: str, epoch: int) -> str:
    return f"{target.rstrip('/')}/epoch={epoch:09d}"


def write_epochs(stream: DataFrame, target: str, checkpoint: str, after_write: Callable[[int], None] | None = None) -> StreamingQuery:
    """Each micro-batch to a folder of its own, which is replaced if the batch is done over.

    Spark commits a batch's offsets when this has written it. A query that dies in between runs the same
    offsets under the same number again, so no row is doubled or lost. A target belongs to one checkpoint.
    ``after_write`` is called between the write and the commit.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(epoch_folder(target, epoch))
        if after_write:
            after_write(epoch)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()


def collect_topic(
    spark: SparkSession, path: str, schema: T.StructType, target: str, checkpoint: str, max_rows: int = 100, stop_after: int | None = None,
    after_write: Callable[[int], None] | None = None,
) -> None:
    """Topic of JSON values -> parquet layer: micro-batches of at most ``max_rows`` records, to the topic's end or for ``stop_after`` records.

    The next call with the same checkpoint goes on where this one stopped.
    """
    stream = topic_stream(spark, path, checkpoint=checkpoint, max_rows=max_rows, stop_after=stop_after)
    query = write_epochs(decode_values(stream, schema), target, checkpoint, after_write)
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def ingest_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    max_offsets_per_trigger: int | None = None,
) -> StreamingQuery:
    """Kafka topic of JSON values -> parquet (needs the spark-sql-kafka package)."""
    rows = decode_values(kafka_stream(spark, servers, topic, max_offsets_per_trigger), schema)
    q = write_raw(rows, target, checkpoint)
    q.awaitTermination()
    return q
