"""Aggregates kept as mergeable states, so that a new batch costs its own rows and not all of history.

A state table is partitioned by ``part``, what can be replaced as a whole (a day). Each
batch leaves one row for each part and group it has: counts, sums, extremes, or a quantile sketch. Reports
merge these rows. A batch that is added again replaces what it left before; a part that is
replaced loses all batches' rows for it. Only the touched parts are read and rewritten;
their number (the days of a batch) is small.

Sums are of doubles, so the last bits depend on how rows fall into batches; reports round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joulebox.plans.loading import path_exists, without_rows
from joulebox.session import stage_table, staging

PART, BATCH = "part", "batch"
GROUPS = ["BuildingType", "HVACSystem"]
#: Size of a quantile sketch: a rank error of about 0.005.
SKETCH_K = 800


def energy_states(features: DataFrame, part: Column) -> DataFrame:
    """One row for each part, building type and system."""
    e, a = F.col("EnergyConsumption"), F.col("EnergyPerArea")
    return features.groupBy(part.alias(PART), *GROUPS).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(e).alias("energies"),
        F.sum(e).alias("energy"),
        F.min(e).alias("least"),
        F.max(e).alias("most"),
        F.count(a).alias("per_areas"),
        F.sum(a).alias("per_area"),
    )


def sketches(features: DataFrame, part: Column, columns: list[str], k: int = SKETCH_K) -> DataFrame:
    """One row for each part and column: a KLL sketch of its numbers."""
    numbers = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]))
    flat = features.select(part.alias(PART), numbers.alias("e")).select(PART, "e.*").where(F.col("x").isNotNull() & ~F.isnan("x"))
    return flat.groupBy(PART, "column").agg(F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double("x", F.lit(k)).alias("sketch"))


def _rewrite(spark: SparkSession, path: str, fresh: DataFrame, stale: Column) -> None:
    """Put ``fresh`` rows in and take ``stale`` ones out, in the parts that have either."""
    with staging(spark):
        fresh = stage_table(fresh, "states")
        parts, rows = fresh.select(PART), fresh
        if path_exists(spark, path):
            old = spark.read.schema(fresh.schema).parquet(path)
            parts = parts.union(old.where(stale).select(PART))
            touched = [r[0] for r in parts.distinct().collect()]
            here = F.col(PART).isin([p for p in touched if p is not None])
            rows = old.where((here | F.col(PART).isNull()) & ~F.coalesce(stale, F.lit(False))).unionByName(fresh)
        else:
            touched = [r[0] for r in parts.distinct().collect()]
        rows = stage_table(rows, "states")
        left = {r[0] for r in rows.select(PART).distinct().collect()}
        rows.repartition(F.col(PART)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
        without_rows(spark, path, PART, [p for p in touched if p not in left])


def add_batch(spark: SparkSession, path: str, states: DataFrame, batch: str) -> None:
    """Add a batch's states; those that the same batch left before go."""
    _rewrite(spark, path, states.withColumn(BATCH, F.lit(batch)), F.col(BATCH) == batch)


def replace_parts(spark: SparkSession, path: str, states: DataFrame, batch: str) -> None:
    """The parts of ``states`` have these rows from now on, and none of any other batch."""
    with staging(spark):
        states = stage_table(states.withColumn(BATCH, F.lit(batch)), "states")
        parts = [r[0] for r in states.select(PART).distinct().collect()]
        _rewrite(spark, path, states, F.col(PART).isin([p for p in parts if p is not None]) | (F.col(PART).isNull() if None in parts else F.lit(False)))


def _average(total: str, n: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(n))


def energy_by(states: DataFrame, key: str) -> DataFrame:
    """``operators.aggregates.energy_by`` of all rows that the states stand for."""
    return states.groupBy(key).agg(
        F.sum("rows").alias("RecordCount"),
        F.round(_average("energy", "energies"), 2).alias("AverageEnergy"),
        F.round(F.sum("energy"), 2).alias("TotalEnergy"),
        F.round(_average("per_area", "per_areas"), 4).alias("AverageEnergyPerArea"),
    )


def energy_statistics(states: DataFrame) -> DataFrame:
    """``operators.aggregates.energy_statistics`` of all rows that the states stand for."""
    return states.agg(
        F.round(_average("energy", "energies"), 2).alias("AverageEnergy"),
        F.round(F.min("least"), 2).alias("MinimumEnergy"),
        F.round(F.max("most"), 2).alias("MaximumEnergy"),
        F.round(F.sum("energy"), 2).alias("TotalEnergy"),
        F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("TotalRecords"),
    )


def sketched_quantiles(stored: DataFrame, probabilities: list[float]) -> DataFrame:
    """(column, probability, value) from the merged sketches; the rows themselves are not read."""
    merged = stored.groupBy("column").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    ranks = F.array(*[F.lit(float(p)) for p in probabilities])
    pairs = F.arrays_zip(ranks.alias("probability"), F.kll_sketch_get_quantile_double("sketch", ranks).alias("value"))
    return merged.select("column", F.inline(pairs)).toDF("column", "probability", "value")


def sketched_bounds(stored: DataFrame, factor: float = 3.0) -> DataFrame:
    """(column, lower, upper): quartiles less and plus ``factor`` interquartile ranges, a row for each column."""
    q = F.kll_sketch_get_quantile_double
    merged = stored.groupBy("column").agg(F.kll_merge_agg_double("sketch").alias("s")).select("column", q("s", F.lit(0.25)).alias("q1"), q("s", F.lit(0.75)).alias("q3"))
    spread = F.lit(factor) * (F.col("q3") - F.col("q1"))
    return merged.select("column", (F.col("q1") - spread).alias("lower"), (F.col("q3") + spread).alias("upper"))
