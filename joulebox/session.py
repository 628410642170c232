"""Session helpers.

Library functions never create sessions; jobs, tests and the bench do. The
checkpoint directory is read from ``spark.checkpoint.dir``; only a local session
(tests, the bench) may go without and gets a scratch folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Observation, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "joulebox") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="joulebox-wh-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the session names.

    Only a ``local`` session may go without one: all its tasks see the same
    disk, so it gets a scratch folder. On a cluster every executor would write its
    parts to its own disk, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = scratch_folder(sc.master)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_folder(master: str) -> str:
    """A new temporary folder for a local master; an error for any other."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is not set and the master is {master}: name a folder that all executors share")
    return tempfile.mkdtemp(prefix="joulebox-ckpt-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint directory for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


#: Folders staged by the scopes that are open in this thread, the innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("staging-scopes", default=())


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of whatever file system it is on."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staging(spark: SparkSession):
    """Own the copies that ``stage_table`` makes inside: they are deleted when the block ends.

    A job wraps its whole work in it; what the job returns or has written must not read them.
    """
    own: list[str] = []
    before = _SCOPES.set((*_SCOPES.get(), own))
    try:
        yield
    finally:
        _SCOPES.reset(before)
        for path in own:
            delete_path(spark, path)


def stage_table(df, name: str, compression: str | None = None):
    """Write ``df`` as parquet to a fresh folder under the shared checkpoint
    directory and return a frame reading it back.

    Used where a plan would otherwise be computed twice (statistics first,
    then the rows): the second use scans stored columns, with pruning and
    filter pushdown, and the lineage is cut, so a lost executor only costs a
    re-read. The innermost open ``staging`` block owns the folder; without one
    it lasts as long as the checkpoint folder. ``compression`` is the codec of the
    files, the session's unless named.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    if scopes := _SCOPES.get():
        scopes[-1].append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_table_observed(df, name: str, metrics: dict, compression: str | None = None):
    """``stage_table`` that also returns aggregate ``metrics`` ({alias: Column})
    computed by the same write through ``DataFrame.observe`` (no extra pass)."""
    obs = Observation(name)
    observed = df.observe(obs, *[m.alias(k) for k, m in metrics.items()])
    out = stage_table(observed, name, compression)
    return out, obs.get
