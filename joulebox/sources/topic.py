"""A topic kept in files, read as a stream: the shape of a Kafka topic without a broker.

``publish`` appends rows to a topic's folder as records (key, value, partition,
offset, timestamp), dealt over the partitions in their order, and lists the written files
with their offset ranges. ``StoredTopic`` is a streaming data source over such a folder: offsets
are tracked per partition in the query's checkpoint, a read takes only the files and their row groups that
hold its offsets, and a micro-batch is cut into equal ranges so that all cores share it.

Options: ``path`` (the folder), ``topic`` (its name), ``startingOffsets`` (``earliest`` or ``latest``),
``maxOffsetsPerTrigger`` (rows of a micro-batch at most), ``stopAfter`` (rows at most since
the query was started), ``interval`` (seconds between two micro-batches' worth of rows, for a replay
at a pace), ``minPartitions`` (tasks to deal a micro-batch to where it has the rows). A source does not learn from Spark where a restarted query stands,
so the row bounds need ``checkpoint``, the query's checkpoint folder, whose offset log says it.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from joulebox.operators.indexing import global_index

PARTITIONS = 3
ROWS_PER_TASK = 1_000_000
ROWS_PER_RANGE = 10_000  # fewer are not worth another task
ROWS_PER_FILE = 100_000  # a read opens whole files: short ones keep it near the rows that it wants
ROWS_PER_GROUP = 10_000  # and decodes whole row groups
SCHEMA = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
_COLUMNS = ["key", "value", "offset", "timestamp"]


def publish(
    df: DataFrame, path: str, order: list[Column | str], key: Column | None = None, partitions: int = PARTITIONS, timestamp: Column | None = None
) -> None:
    """Append the rows of ``df`` to the topic as JSON values, one record each, in ``order``.

    A record goes to partition ``position % partitions``, so partitions are equally long whatever the keys. Offsets go on
    where the topic ends. One publisher at a time.
    """
    spark = df.sparkSession
    ends = _ends(_segments(path))
    first = F.get(F.array(*[F.lit(ends.get(str(p), 0)).cast("long") for p in range(partitions)]), F.pmod("_row", F.lit(partitions)).cast("int"))
    numbered = global_index(df, order, "_row")
    records = numbered.select(
        (key.cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        F.pmod("_row", F.lit(partitions)).cast("int").alias("partition"),
        (F.floor(F.col("_row") / partitions) + first).alias("offset"),
        (timestamp if timestamp is not None else F.current_timestamp()).alias("timestamp"),
    )
    part = f"{path.rstrip('/')}/log/{time.time_ns()}"
    in_order = records.sortWithinPartitions("partition", "offset")
    layout = {"maxRecordsPerFile": ROWS_PER_FILE, "parquet.block.row.count.limit": ROWS_PER_GROUP, "parquet.enable.dictionary#value": "false"}
    in_order.write.options(**layout).partitionBy("partition").parquet(part)
    written = spark.read.parquet(part).groupBy(F.expr("_metadata.file_path").alias("file"), "partition")
    files = written.agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    files.select("file", F.col("partition").cast("int"), "first", "last").coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/segments")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _segments(path: str) -> list[dict]:
    """The topic's files (file, partition, first, last): a line for each, read by the query's planner."""
    store, base = _open(path.rstrip("/") + "/segments")
    found = []
    if store.get_file_info(base).type == fs.FileType.Directory:
        for info in store.get_file_info(fs.FileSelector(base)):
            if info.base_name.startswith("part-"):
                with store.open_input_stream(info.path) as f:
                    found += [json.loads(line) for line in f.read().splitlines()]
    return found


def _ends(segments: list[dict]) -> dict[str, int]:
    """The offset after the last record of each partition."""
    out: dict[str, int] = {}
    for s in segments:
        name = str(s["partition"])
        out[name] = max(out.get(name, 0), s["last"] + 1)
    return out


def advance(position: dict[str, int], ends: dict[str, int], rows: int | None) -> dict[str, int]:
    """The offsets after at most ``rows`` further records, dealt as evenly as the partitions allow."""
    out = {p: max(position.get(p, 0), e if rows is None else position.get(p, 0)) for p, e in ends.items()}
    if rows is None:
        return out
    waiting = sorted(ends, key=lambda p: (ends[p] - out[p], p))  # the shortest first: what it leaves goes to the others
    for i, p in enumerate(waiting):
        some = min(max(0, ends[p] - out[p]), -(-rows // (len(waiting) - i)))
        out[p] += some
        rows -= some
    return out


def checkpointed(checkpoint: str, source: int = 0) -> dict[str, int] | None:
    """Where the last planned micro-batch of a query ends, by the offset log of its checkpoint."""
    store, base = _open(checkpoint.rstrip("/") + "/offsets")
    if store.get_file_info(base).type != fs.FileType.Directory:
        return None
    batches = [int(i.base_name) for i in store.get_file_info(fs.FileSelector(base)) if i.base_name.isdigit()]
    if not batches:
        return None
    with store.open_input_stream(f"{base}/{max(batches)}") as f:
        lines = f.read().decode().splitlines()  # version, batch metadata, then a line for each source
    return json.loads(lines[2 + source])


class Range(InputPartition):
    """What a task reads: pieces (partition, first offset, end, files that hold some of it)."""

    def __init__(self, pieces: list[tuple[int, int, int, list[str]]]):
        self.pieces = pieces


def cut(start: dict[str, int], end: dict[str, int], tasks: int) -> list[list[tuple[str, int, int]]]:
    """The records between two positions as equally long runs of (partition, first offset, end): one for each task, fewer where they
    would be short, more where they would be long.

    A run may take the rest of one partition and the beginning of the next, so the longest task is no longer than the others.
    """
    rows = {p: max(0, stop - start.get(p, 0)) for p, stop in sorted(end.items())}
    total, before = sum(rows.values()), 0
    n = max(min(tasks, total // ROWS_PER_RANGE), -(-total // ROWS_PER_TASK))
    bounds = [total * i // n for i in range(n + 1)] if n else [0]
    out: list[list[tuple[str, int, int]]] = [[] for _ in bounds[1:]]
    for p, length in rows.items():
        for run, lo, hi in zip(out, bounds, bounds[1:], strict=False):
            lo, hi = max(lo, before), min(hi, before + length)
            if lo < hi:
                run.append((p, end[p] - length + lo - before, end[p] - length + hi - before))
        before += length
    return out


class TopicReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.topic = options["path"], options.get("topic", "readings")
        self.starting = options.get("startingoffsets", "earliest")
        number = lambda name: int(options[name]) if options.get(name) else None
        self.rows, self.stop_after, self.interval = number("maxoffsetspertrigger"), number("stopafter"), float(options.get("interval", 0))
        self.checkpoint, self.tasks = options.get("checkpoint"), number("minpartitions") or 1
        if (self.rows or self.stop_after) and not self.checkpoint:
            raise ValueError("maxOffsetsPerTrigger and stopAfter need the option checkpoint")
        self.position: dict[str, int] | None = None
        self.left, self.offered_at = self.stop_after, 0.0

    def initialOffset(self) -> dict:
        ends = _ends(_segments(self.path))
        return ends if self.starting == "latest" else {p: 0 for p in ends}

    def latestOffset(self) -> dict:
        if self.position is None:
            self.position = (checkpointed(self.checkpoint) if self.checkpoint else None) or self.initialOffset()
        bounds = [b for b in (self.rows, self.left) if b is not None]
        if self.interval and time.time() - self.offered_at < self.interval:
            return self.position
        after = advance(self.position, _ends(_segments(self.path)), min(bounds) if bounds else None)
        if after != self.position:
            taken = sum(after.values()) - sum(self.position.values())
            self.left = self.left - taken if self.left is not None else None
            self.position, self.offered_at = after, time.time()
        return self.position

    def partitions(self, start: dict, end: dict) -> list[Range]:
        segments = _segments(self.path)
        held = lambda p, lo, hi: [s["file"] for s in segments if str(s["partition"]) == p and s["first"] < hi and s["last"] >= lo]
        return [Range([(int(p), lo, hi, held(p, lo, hi)) for p, lo, hi in run]) for run in cut(start, end, self.tasks)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        for number, first, end, files in partition.pieces:
            for file in files:
                yield from self._records(number, first, end, file)

    def _records(self, number: int, first: int, end: int, file: str) -> Iterator[pa.RecordBatch]:
        store, at = _open(file)
        within = [("offset", ">=", first), ("offset", "<", end)]
        found = pq.read_table(at, filesystem=store, columns=_COLUMNS, filters=within, partitioning=None)
        n = found.num_rows
        columns = {
            "key": found["key"].cast(pa.binary()),
            "value": found["value"].cast(pa.binary()),
            "topic": pa.array([self.topic] * n, pa.string()),
            "partition": pa.array([number] * n, pa.int32()),
            "offset": found["offset"].cast(pa.int64()),
            "timestamp": found["timestamp"].cast(pa.timestamp("us", "UTC")),
        }
        yield from pa.table(columns).to_batches(max_chunksize=10_000)


class StoredTopic(DataSource):
    """``spark.readStream.format("stored_topic")``, after ``register``."""

    @classmethod
    def name(cls) -> str:
        return "stored_topic"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TopicReader:  # noqa: ANN001
        return TopicReader({k.lower(): v for k, v in self.options.items()})


def topic_stream(
    spark: SparkSession, path: str, topic: str = "readings", checkpoint: str | None = None, max_rows: int | None = None, stop_after: int | None = None,
    interval: float | None = None, starting_offsets: str = "earliest",
) -> DataFrame:
    """The topic's records as a stream; the same columns as a Kafka topic's (but its headers)."""
    spark.dataSource.register(StoredTopic)
    tasks = spark.sparkContext.defaultParallelism
    given = {"path": path, "topic": topic, "checkpoint": checkpoint, "maxOffsetsPerTrigger": max_rows, "stopAfter": stop_after, "interval": interval, "minPartitions": tasks}
    reader = spark.readStream.format("stored_topic").option("startingOffsets", starting_offsets)
    for name, value in given.items():
        if value is not None:
            reader = reader.option(name, str(value))
    return reader.load()
