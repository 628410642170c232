"""Registered queries and their DuckDB oracle twins.

Each query takes (spark, sf_dir) and returns a DataFrame over the driver
tables (whole tables, no row caps beyond the report limits that are the
feature). The oracle strings use DuckDB SQL on views named like the tables.
Column names and types are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


_MEMO: dict = {}


def memo(spark: SparkSession, key, compute):
    """Per-session cache for small driver-side values (bounds, cuts, coefficients) and staged tables.

    ``key`` ends with the tables' folder; its files' sizes and times are part of the key, so new data
    under the same path is computed anew.
    """
    full = (spark.sparkContext.applicationId, key, _identity(spark, key[-1]))
    if full not in _MEMO:
        _MEMO[full] = compute()
    return _MEMO[full]


def _identity(spark: SparkSession, folder: str) -> tuple:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path)))


def clear_memo() -> None:
    """Forget memoised values (the bench measures each query from scratch)."""
    _MEMO.clear()


def load_all() -> None:
    """Import the modules that register queries (idempotent)."""
    from joulebox.queries import (  # noqa: F401
        q_cleaning,
        q_model,
        q_reports,
        q_scalar,
        q_star,
        q_stream,
    )
