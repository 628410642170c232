"""Which files of a folder have been taken, and by which run.

A file is known by its path, size and modification time (Spark's hidden
``_metadata`` columns), so a file that arrives later is taken whatever batch its
rows belong to, and a file that is replaced is taken again. The ledger is two
folders: ``claims`` (the files of each run) and ``done`` (runs that finished).
Run ids sort by the time of the claim. A run that broke off is done over with the
same files and the same id, so its output can replace what it may have left.

The listing reads no file contents. Paths of the files to read are the only thing that
reaches the driver, which holds them for any scan of the folder anyway.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulebox.plans.loading import path_exists

IDENTITY = ["file_path", "file_size", "file_modification_time"]


@dataclass
class Run:
    run_id: str
    paths: list[str]


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file_path, file_size, file_modification_time) of the data files below a folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(escape_glob(folder))
    # the path as it is: the hidden one is an encoded URL, which readers do not take
    return found.select(F.col("path").alias("file_path"), "_metadata.file_size", "_metadata.file_modification_time")


def escape_glob(path: str) -> str:
    """A path that Spark's readers take literally."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def untaken(files: DataFrame, claims: DataFrame) -> DataFrame:
    return files.join(claims.select(*IDENTITY), IDENTITY, "left_anti")


def _open_runs(spark: SparkSession, ledger: str) -> list[str]:
    claims, done = f"{ledger}/claims", f"{ledger}/done"
    if not path_exists(spark, claims):
        return []
    runs = spark.read.parquet(escape_glob(claims)).select("run_id").distinct()
    if path_exists(spark, done):
        runs = runs.join(spark.read.parquet(escape_glob(done)).select("run_id"), "run_id", "left_anti")
    return [r["run_id"] for r in runs.orderBy("run_id").collect()]


def claim(spark: SparkSession, folder: str, ledger: str) -> Run | None:
    """An earlier run that did not finish, or a new one over the files that none has taken; None if there are none."""
    claims = f"{ledger}/claims"
    for run_id in _open_runs(spark, ledger):
        own = spark.read.parquet(escape_glob(claims)).filter(F.col("run_id") == run_id)
        return Run(run_id, sorted(r["file_path"] for r in own.select("file_path").collect()))
    files = list_files(spark, folder)
    if path_exists(spark, claims):
        files = untaken(files, spark.read.parquet(escape_glob(claims)))
    rows = [tuple(r) for r in files.collect()]
    if not rows:
        return None
    run_id = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    taken = spark.createDataFrame(rows, files.schema).withColumns({"run_id": F.lit(run_id), "claimed_at": F.current_timestamp()})
    taken.coalesce(1).write.mode("append").parquet(claims)  # one file: a claim is there wholly or not at all
    return Run(run_id, sorted(r[0] for r in rows))


def finish(spark: SparkSession, ledger: str, run_id: str) -> None:
    """Mark a run as finished."""
    done = spark.range(1).select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("finished_at"))
    done.coalesce(1).write.mode("append").parquet(f"{ledger}/done")


def finished(spark: SparkSession, ledger: str) -> set[str]:
    if not path_exists(spark, f"{ledger}/done"):
        return set()
    return {r["run_id"] for r in spark.read.parquet(escape_glob(f"{ledger}/done")).select("run_id").distinct().collect()}


def read_run(spark: SparkSession, run: Run, folder: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """The rows of a run's files, and of no others."""
    reader = spark.read.format(fmt).options(**options).option("basePath", folder)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load([escape_glob(p) for p in run.paths])
