"""A warehouse-like sink: tables written by tasks to a folder of their own and published by one commit.

``spark.write.format("published_parquet")`` (after ``register``): every task writes its rows to
Parquet files of a new version of the table, at ``path``. When all have, the commit names the version in one small file, which
replaces the one that names the last version in one rename; a failed job removes what its tasks wrote and the table
stays as it was. ``read_published`` reads the version that is named now. Versions that were replaced stay for their readers
until ``remove_old_versions``.

Files are opened through ``pyarrow.fs`` in a folder that all executors share.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

CURRENT = "CURRENT.json"
ROW_GROUP_BYTES = 64 << 20


@dataclass
class Written(WriterCommitMessage):
    files: list[str]
    rows: int


class PublishedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, schema):  # noqa: ANN001
        if not overwrite:
            raise ValueError("published_parquet replaces a table: use mode('overwrite')")
        self.path, self.schema = path.rstrip("/"), schema
        self.version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def _open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = self._open()
        store.create_dir(f"{base}/{self.version}", recursive=True)
        name, rows, out, held, size = f"part-{uuid.uuid4().hex}.parquet", 0, None, [], 0
        for batch in iterator:
            if out is None:
                out = pq.ParquetWriter(f"{base}/{self.version}/{name}", batch.schema, filesystem=store, compression="zstd")
            held.append(batch)
            size += batch.nbytes
            rows += batch.num_rows
            if size >= ROW_GROUP_BYTES:
                out.write_table(pa.Table.from_batches(held))
                held, size = [], 0
        if out is not None:
            if held:
                out.write_table(pa.Table.from_batches(held))
            out.close()
        return Written([name] if out is not None else [], rows)

    def commit(self, messages: list[Written | None]) -> None:
        store, base = self._open()
        store.create_dir(f"{base}/{self.version}", recursive=True)
        done = [m for m in messages if m is not None]
        named = {"version": self.version, "files": sorted(f for m in done for f in m.files), "rows": sum(m.rows for m in done), "schema": self.schema.json()}
        draft = f"{base}/{self.version}.json"
        with store.open_output_stream(draft, compression=None) as f:
            f.write(json.dumps(named).encode())
        store.move(draft, f"{base}/{CURRENT}")  # the one step that readers see

    def abort(self, messages: list[Written | None]) -> None:
        store, base = self._open()
        if store.get_file_info(f"{base}/{self.version}").type == fs.FileType.Directory:
            store.delete_dir(f"{base}/{self.version}")


class PublishedParquet(DataSource):
    @classmethod
    def name(cls) -> str:
        return "published_parquet"

    def schema(self) -> str:
        raise NotImplementedError("published_parquet is a sink; read it with read_published")

    def writer(self, schema, overwrite: bool) -> PublishedWriter:  # noqa: ANN001
        return PublishedWriter(self.options["path"], overwrite, schema)


def publish(df: DataFrame, path: str) -> None:
    """Replace the table at ``path`` by the rows of ``df``, wholly or not at all."""
    df.sparkSession.dataSource.register(PublishedParquet)
    df.write.format("published_parquet").mode("overwrite").option("path", path).save()


def current(path: str) -> dict | None:
    """What the last commit named: version, files, rows, schema; None before the first."""
    store, base = fs.FileSystem.from_uri(path.rstrip("/"))
    if store.get_file_info(f"{base}/{CURRENT}").type != fs.FileType.File:
        return None
    with store.open_input_stream(f"{base}/{CURRENT}", compression=None) as f:
        return json.loads(f.read())


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows; files that no commit names (of repeated task attempts) are left out."""
    from pyspark.sql.types import StructType

    named = current(path)
    if named is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    schema = StructType.fromJson(json.loads(named["schema"]))
    if not named["files"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{named['version']}/{f}" for f in named["files"]])


def remove_old_versions(path: str, retain_seconds: float = 7 * 86_400) -> list[str]:
    """Remove versions begun more than ``retain_seconds`` ago that are not the current one; returns their names."""
    store, base = fs.FileSystem.from_uri(path.rstrip("/"))
    named, gone = current(path), []
    for info in store.get_file_info(fs.FileSelector(base)):
        begun = info.base_name.split("-")[0]
        if info.type == fs.FileType.Directory and begun.isdigit() and (named is None or info.base_name != named["version"]):
            if time.time_ns() - int(begun) >= retain_seconds * 1e9:
                store.delete_dir(info.path)
                gone.append(info.base_name)
    return gone
