"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding whole WARC records, ended by
a skippable frame with the seek table: compressed size, size and checksum of each frame
(the low half of its XXH64), then the number of frames, a descriptor byte and a magic
number. Any Zstandard tool unpacks a bundle to plain WARC; with the table a reader
finds a frame without unpacking those before it. An index, written as Parquet beside the bundles,
maps each record to its bundle, frame and offset within the frame.

Tasks write bundles on their own (files of a new name each, closed at BUNDLE_BYTES) and return
the index rows of what they wrote. A task that runs again writes new files; only files
that the index names belong to the archive, others are removed when the index is complete.
A task holds one frame and one batch of rows.

Equal payloads of at least ``least`` bytes are stored once: the record with the largest
id is the ``response``, the others are ``revisit`` records that refer to it and carry the
payload's digest and length in their headers. Groups that hold a thousandth of the rows or more
(a thousand groups at most) are looked up by broadcast, so that their rows stay where they are;
the rest are joined by payload hash.

Files are opened through ``pyarrow.fs`` (a path, or a URI of file, hdfs, s3, gs) in a
folder that all executors share.

Edge cases: null payloads are empty. Rows with a null id are records without an id; they can be
revisits, and are a response only where the whole group has no id. Repeated rows are records each, all rows with the
largest id are responses. A null url gives no target line; line breaks in it are written %0D
and %0A. A very long payload is a frame of its own. An empty table gives no bundle and an
empty index. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joulebox.session import delete_path, scratch_path

from .tables import parts_for

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 128 << 20
CHUNK_FRAMES = 64
READ_BYTES = 32 << 20
HOT_SHARE = 1000
BATCH_BYTES = 8 << 20

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<III")

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "id long, record_type string, refers_to long, archive string, frame int, at long, length long, bytes long"
_FOUND = "id long, record_type string, refers_to long, payload_bytes long, payload_digest string, url string, payload binary"


def _name(number: int | None) -> str:
    return f"<urn:page:{'' if number is None else number}>"


def _number(name: str) -> int | None:
    return int(name[10:-1]) if name != "<urn:page:>" else None


def encode_record(number: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response, or a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_name(number)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes | None, int]:
    """(headers, payload or None for a revisit, end) of the record at ``at``; a wrong digest is an error."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    begin, size = stop + 4, int(head["Content-Length"])
    end = begin + size + 4
    if data[end - 4 : end] != b"\r\n\r\n":
        raise ValueError(f"record at {at} is cut")
    if head["WARC-Type"] == "revisit":
        return head, None, end
    payload = data[data.index(b"\r\n\r\n", begin) + 4 : end - 4]
    if f"sha1:{hashlib.sha1(payload).hexdigest()}" != head["WARC-Payload-Digest"]:
        raise ValueError(f"{head['WARC-Record-ID']}: payload does not have its digest")
    return head, payload, end


class BundleWriter:
    """One bundle: ``add`` returns (frame, offset within it, size) of a record."""

    def __init__(self, sink, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.sink, self.frame_bytes, self.zstd = sink, frame_bytes, zstandard.ZstdCompressor(level=level)
        self.table: list[tuple[int, int, int]] = []
        self.held, self.size, self.written = [], 0, 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        if self.size and self.size + len(record) > self.frame_bytes:
            self.flush()
        place = len(self.table), self.size, len(record)
        self.held.append(record)
        self.size += len(record)
        return place

    def flush(self) -> None:
        if self.size:
            data = b"".join(self.held)
            packed = self.zstd.compress(data)
            self.sink.write(packed)
            self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
            self.written += len(packed)
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, ENTRY.size * len(self.table) + FOOTER.size))
        self.sink.write(b"".join(ENTRY.pack(*e) for e in self.table) + FOOTER.pack(len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC))
        self.sink.close()


class BundleReader:
    """Frames of a bundle, found through its seek table."""

    def __init__(self, path: str):
        store, at = fs.FileSystem.from_uri(path)
        self.file, self.path = store.open_input_file(at), path
        end = self.file.size()
        n, flags, magic = FOOTER.unpack(self._read(end - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError(f"{path}: no seek table")
        table = self._read(end - FOOTER.size - n * ENTRY.size, n * ENTRY.size)
        self.frames, start = [], 0
        for packed, size, check in ENTRY.iter_unpack(table):
            self.frames.append((start, packed, size, check))
            start += packed

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def frame(self, n: int) -> bytes:
        start, packed, size, check = self.frames[n]
        data = zstandard.ZstdDecompressor().decompress(self._read(start, packed), max_output_size=size)
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"{self.path}: frame {n} is damaged")
        return data

    def close(self) -> None:
        self.file.close()


def with_kinds(pages: DataFrame, least: int) -> DataFrame:
    """(id, url, payload, refers_to): ``refers_to`` is the id of the response that a revisit repeats."""
    size = F.octet_length(F.col("payload"))
    rows = pages.withColumn("key", F.when(size >= least, F.sha2(F.col("payload").cast("binary"), 256)))
    copies = rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.max("id").alias("kept"), F.count(F.lit(1)).alias("n"))
    copies = copies.where((F.col("n") > 1) & F.col("kept").isNotNull())
    many = pages.count() // HOT_SHARE
    hot = F.broadcast(copies.where(F.col("n") > many).select("key", "kept"))  # HOT_SHARE rows at most
    cold = copies.where(F.col("n") <= many).select("key", F.col("kept").alias("cold_kept"))
    met = rows.join(hot, "key", "left")
    still = met.where(F.col("key").isNull() | F.col("kept").isNotNull())
    rest = met.where(F.col("key").isNotNull() & F.col("kept").isNull()).drop("kept").join(cold, "key", "left").withColumnRenamed("cold_kept", "kept")
    both = still.select("id", "url", "payload", "kept").unionByName(rest.select("id", "url", "payload", "kept"))
    revisit = F.col("kept").isNotNull() & ~F.col("id").eqNullSafe(F.col("kept"))
    return both.select("id", "url", "payload", F.when(revisit, F.col("kept")).alias("refers_to"))


def write_bundles(
    pages: DataFrame, path: str, least: int = 1000, date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write an archive of ``pages`` to the new folder ``path``; returns its index."""
    spark = pages.sparkSession
    folder = path.rstrip("/") + "/bundles"
    own = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        part, bundle, name, rows = TaskContext.get().partitionId(), None, "", []

        def index() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = [c.split()[0] for c in _INDEX.split(", ")]
            return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

        for batch in batches:
            number, url, payload, refers = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                if bundle is None:
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.zst"
                    bundle = BundleWriter(store.open_output_stream(f"{base}/{name}", compression=None), frame_bytes)
                body, to = payload[i].as_py().encode(), refers[i].as_py()
                place = bundle.add(encode_record(number[i].as_py(), url[i].as_py(), body, to, date))
                rows.append((number[i].as_py(), "response" if to is None else "revisit", to, f"{folder}/{name}", *place, len(body)))
                if bundle.written >= bundle_bytes:
                    bundle.close()
                    bundle = None
            if rows:
                yield index()
                rows.clear()
        if bundle is not None:
            bundle.close()

    with_kinds(own, least).mapInArrow(run, _INDEX).write.parquet(path.rstrip("/") + "/index")
    found = read_index(spark, path)
    _sweep(spark, folder, {r["archive"] for r in found.select("archive").distinct().collect()})  # one name a file
    return found


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(path.rstrip("/") + "/index")


def _sweep(spark: SparkSession, folder: str, named: set[str]) -> None:
    """Remove the files of attempts that the index does not name."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.exists(target):
        kept = {n.rsplit("/", 1)[1] for n in named}
        for status in store.listStatus(target):
            if status.getPath().getName() not in kept:
                delete_path(spark, status.getPath().toString())


def _read(units: DataFrame, payloads: bool) -> DataFrame:
    """Records at (archive, frames, at): whole frames, or where ``at`` is given the records that begin there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def emit() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            names = [c.split()[0] for c in _FOUND.split(", ")]
            return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

        for batch in batches:
            for unit in batch.to_pylist():
                bundle = BundleReader(unit["archive"])
                for n in unit["frames"]:
                    data = bundle.frame(n)
                    at, wanted = 0, iter(unit["at"]) if unit["at"] is not None else None
                    while (at := next(wanted, len(data)) if wanted else at) < len(data):
                        head, payload, at = decode_record(data, at)
                        refers = _number(head["WARC-Refers-To"]) if payload is None else None
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        kept = payload if payloads else None
                        rows.append((_number(head["WARC-Record-ID"]), head["WARC-Type"], refers, int(head["X-Payload-Length"]), digest, head.get("WARC-Target-URI"), kept))
                        size += 200 + len(kept or b"")
                        if size >= BATCH_BYTES:
                            yield emit()
                            rows, size = [], 0
                bundle.close()
        if rows:
            yield emit()

    return units.mapInArrow(run, _FOUND)


def _apart(*columns: str) -> Column:
    """A key to deal units of work by: the units are few and small, so a shuffle on their own
    columns would be merged with the one that made them, and its partitions joined to one."""
    return F.xxhash64(*columns, F.lit(3))


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """All records of an archive: (id, record_type, refers_to, payload_bytes, payload_digest, url, payload).

    Runs of CHUNK_FRAMES frames are dealt to tasks, which seek to them; digests are verified.
    ``payload`` is null for revisits, and for all unless ``payloads``.
    """
    index = read_index(spark, path)
    chunk = F.floor(F.col("frame") / CHUNK_FRAMES)
    units = index.groupBy("archive", chunk.alias("chunk")).agg(F.sort_array(F.collect_set("frame")).alias("frames"))
    dealt = units.repartition(parts_for(index, READ_BYTES // 100), _apart("archive", "chunk"))
    return _read(dealt.select("archive", "frames", F.lit(None).cast("array<long>").alias("at")), payloads)


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(id, payload) of the ids of the one column of ``wanted``, revisits resolved; only their frames are read.

    A repeated id is answered by the records of all its rows' distinct payloads.
    """
    index = read_index(spark, path)
    asked = wanted.toDF("id").distinct().join(index, "id").select("id", F.coalesce("refers_to", "id").alias("holder")).distinct()
    places = asked.select(F.col("holder").alias("id")).distinct().join(index.where("record_type = 'response'"), "id")
    units = places.groupBy("archive", "frame").agg(F.sort_array(F.collect_set("at")).alias("at"))
    dealt = units.repartition(parts_for(index, READ_BYTES // 100), _apart("archive", "frame")).select("archive", F.array("frame").alias("frames"), "at")
    held = _read(dealt, True).select(F.col("id").alias("holder"), "payload").distinct()
    return asked.join(held, "holder").select("id", "payload")


def digests(found: DataFrame, id_col: str = "page_id") -> DataFrame:
    return found.select(F.col("id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")


def archive(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` and read the records back; without ``path`` in the shared scratch folder."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, f"warc-{uuid.uuid4().hex[:12]}")
    write_bundles(pages, path, **options)
    return digests(read_records(spark, path))
