"""Report queries over the published tables.

Inputs are the cleaned readings with features (``readings``), the health table
(``health``), the prediction table (``pred``) and the three aggregates. Every
report excludes the literal ``'Nan'`` category and applies the optional
``building_type`` / ``hvac_system`` filters as bound literals. Post-processing
that the original did in JavaScript (defaults, scores, messages, shares) is
done here as Catalyst expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from joulebox.functions.numeric import clamp_health_score
from joulebox.functions.text import deviation_message
from joulebox.operators.aggregates import accuracy_report
from joulebox.operators.cleaning import exclude_sentinel, filter_optional
from joulebox.schema import STATUS_ABOVE

B, H = "BuildingType", "HVACSystem"


def scoped(df: DataFrame, building_type: str | None = None, hvac_system: str | None = None) -> DataFrame:
    """Sentinel exclusion plus the optional equality filters."""
    return filter_optional(exclude_sentinel(df, [B, H]), **{B: building_type, H: hvac_system})


def _above() -> F.Column:
    return F.col("EfficiencyStatus") == F.lit(STATUS_ABOVE)


def filters(readings: DataFrame) -> DataFrame:
    """(kind, value): distinct building types and HVAC systems without 'Nan', ordered."""
    entry = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value"))
    both = readings.select(F.explode(F.array(entry("buildingType", B), entry("hvacSystem", H))).alias("e")).select("e.*")
    return both.filter(F.col("value") != "Nan").distinct().orderBy("kind", "value")


def kpis(readings: DataFrame, health: DataFrame, building_type=None, hvac_system=None) -> DataFrame:
    """One row of KPI numbers (0 when a filter matches nothing)."""
    totals = scoped(readings, building_type, hvac_system).agg(
        F.coalesce(F.sum("EnergyConsumption"), F.lit(0.0)).alias("total_energy"),
        F.coalesce(F.avg("EnergyPerArea"), F.lit(0.0)).alias("avg_energy_per_area"),
        F.count_distinct(F.col(B)).alias("building_types"),
    )
    h = scoped(health, building_type, hvac_system).agg(
        F.coalesce(F.avg(clamp_health_score("DeviationPercent")), F.lit(0.0)).alias("avg_health_score"),
        F.count_if(_above()).alias("at_risk_count"),
        F.count(F.lit(1)).alias("total_records"),
    )
    # two one-row aggregates side by side: stack them and keep each non-NULL field
    both = totals.unionByName(h, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in totals.columns + h.columns])


def energy_by_type(
    readings: DataFrame, by_building: DataFrame, building_type=None, hvac_system=None
) -> DataFrame:
    """(name, value) energy per building type, largest first.

    Without an HVAC filter the pre-aggregated table answers (it has no HVAC
    column, so rows whose HVAC is 'Nan' are included); with one, the readings
    are grouped so the filter applies.
    """
    if not hvac_system:
        fast = filter_optional(by_building.filter(F.col(B) != "Nan"), **{B: building_type})
        return fast.select(F.col(B).alias("name"), F.col("TotalEnergy").alias("value")).orderBy(F.desc("value"))
    detail = scoped(readings, building_type, hvac_system).groupBy(B).agg(F.sum("EnergyConsumption").alias("value"))
    return detail.select(F.col(B).alias("name"), "value").orderBy(F.desc("value"))


def energy_by_hvac(readings: DataFrame, by_hvac: DataFrame, building_type=None, hvac_system=None) -> DataFrame:
    """Mirror of ``energy_by_type`` keyed by HVAC system."""
    if not building_type:
        fast = filter_optional(by_hvac.filter(F.col(H) != "Nan"), **{H: hvac_system})
        return fast.select(F.col(H).alias("name"), F.col("TotalEnergy").alias("value")).orderBy(F.desc("value"))
    detail = scoped(readings, building_type, hvac_system).groupBy(H).agg(F.sum("EnergyConsumption").alias("value"))
    return detail.select(F.col(H).alias("name"), "value").orderBy(F.desc("value"))


def stats_summary(statistics: DataFrame) -> DataFrame:
    return statistics.select(
        F.col("AverageEnergy").alias("averageEnergy"),
        F.col("MaximumEnergy").alias("maximumEnergy"),
        F.col("MinimumEnergy").alias("minimumEnergy"),
        F.col("TotalEnergy").alias("totalEnergy"),
        F.col("TotalRecords").alias("totalRecords"),
    )


def risk_level() -> F.Column:
    d = F.col("DeviationPercent")
    return (
        F.when(_above() & (d > 50), F.lit("Critical")).when(_above(), F.lit("Warning")).otherwise(F.lit("Healthy"))
    )


def health_distribution(health: DataFrame, building_type=None, hvac_system=None) -> DataFrame:
    """(name, value): Critical / Warning / Healthy counts."""
    return (
        scoped(health, building_type, hvac_system)
        .groupBy(risk_level().alias("name"))
        .agg(F.count(F.lit(1)).alias("value"))
    )


def health_share(health: DataFrame, building_type=None, hvac_system=None) -> DataFrame:
    """(name, value, percent): class counts and each class's rounded share (half up).

    One conditional aggregation (partial per task) gives the three counts and
    the total; ``stack`` turns the row into classes, absent classes dropped.
    """
    level = risk_level()
    counts = scoped(health, building_type, hvac_system).agg(
        *[F.count_if(level == F.lit(c)).alias(c) for c in ("Critical", "Warning", "Healthy")],
        F.count(F.lit(1)).alias("_total"),
    )
    long = counts.select(
        F.expr("stack(3, 'Critical', Critical, 'Warning', Warning, 'Healthy', Healthy) AS (name, value)"), "_total"
    )
    return long.filter(F.col("value") > 0).select(
        "name", "value", F.round(F.col("value") * 100.0 / F.col("_total"), 0).cast("int").alias("percent")
    )


def energy_vs_area(readings: DataFrame, building_type=None, hvac_system=None, n: int = 200) -> DataFrame:
    """First n (area, energy) points by area; energy breaks ties."""
    return (
        scoped(readings, building_type, hvac_system)
        .select(F.col("RoomArea").alias("area"), F.col("EnergyConsumption").alias("energy"))
        .orderBy("area", "energy")
        .limit(n)
    )


def epa_by_type(readings: DataFrame, building_type=None, hvac_system=None) -> DataFrame:
    return (
        scoped(readings, building_type, hvac_system)
        .groupBy(F.col(B).alias("name"))
        .agg(F.avg("EnergyPerArea").alias("value"))
        .orderBy(F.desc("value"))
    )


def prediction_series(pred: DataFrame, building_type=None, hvac_system=None, n: int = 100) -> DataFrame:
    """n (index, actual, predicted) points numbered from 1, in (actual, predicted) order.

    The original took 400 unordered rows and showed the first 100; here the
    sample is ordered so it is the same on every run. The numbering window
    runs over the n limited rows only.
    """
    pts = (
        scoped(pred, building_type, hvac_system)
        .select(F.col("EnergyConsumption").alias("actual"), F.col("prediction").alias("predicted"))
        .orderBy("actual", "predicted")
        .limit(n)
    )
    return pts.withColumn("index", F.row_number().over(Window.orderBy("actual", "predicted"))).select(
        "index", "actual", "predicted"
    )


def prediction_accuracy(pred: DataFrame, building_type=None, hvac_system=None) -> DataFrame:
    """MAE, RMSE, MAPE, R^2 over all matching prediction rows."""
    pts = scoped(pred, building_type, hvac_system).select(
        F.col("EnergyConsumption").alias("actual"), F.col("prediction").alias("predicted")
    )
    return accuracy_report(pts)


def type_health(health: DataFrame, building_type=None, hvac_system=None) -> DataFrame:
    d = F.col("DeviationPercent")
    return (
        scoped(health, building_type, hvac_system)
        .groupBy(B)
        .agg(
            F.avg(clamp_health_score("DeviationPercent")).alias("health_score"),
            F.count_if(_above() & (d > 50)).alias("critical_cnt"),
            F.count_if(_above() & (d <= 50)).alias("warning_cnt"),
        )
    )


def top_energy_types(readings: DataFrame, building_type=None, hvac_system=None, k: int = 5) -> DataFrame:
    return (
        scoped(readings, building_type, hvac_system)
        .groupBy(B)
        .agg(F.sum("EnergyConsumption").alias("total_energy"), F.avg("EnergyPerArea").alias("avg_epa"))
        .orderBy(F.desc("total_energy"), F.asc(B))
        .limit(k)
    )


def top_types(readings: DataFrame, health: DataFrame, building_type=None, hvac_system=None, k: int = 5) -> DataFrame:
    """Top k types by energy with score (default 75, also for a 0 score) and risk level."""
    top = top_energy_types(readings, building_type, hvac_system, k)
    j = top.join(type_health(health, building_type, hvac_system), B, "left")  # one row per type on either side
    score = F.col("health_score")
    score = F.when(score.isNull() | (score == 0), F.lit(75.0)).otherwise(score)
    risk = (
        F.when(F.coalesce(F.col("critical_cnt"), F.lit(0)) > 0, F.lit("High"))
        .when(F.coalesce(F.col("warning_cnt"), F.lit(0)) > 0, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )
    return j.orderBy(F.desc("total_energy"), F.asc(B)).select(  # the join has lost the top's order
        F.col(B).alias("buildingType"),
        F.round("total_energy", 0).cast("bigint").alias("totalEnergy"),
        F.round("avg_epa", 1).alias("energyPerArea"),
        F.round(score, 0).cast("bigint").alias("healthScore"),
        risk.alias("riskLevel"),
    )


def largest_deviations(health: DataFrame, building_type=None, hvac_system=None, k: int = 5) -> DataFrame:
    """k rows with the largest |deviation| (NULLs first, as the warehouse orders DESC)."""
    return (
        scoped(health, building_type, hvac_system)
        .select(B, H, "DeviationPercent", "EfficiencyStatus")
        .orderBy(
            F.abs("DeviationPercent").desc_nulls_first(),
            F.asc(B),
            F.asc(H),
            F.col("DeviationPercent").asc_nulls_first(),
            F.asc("EfficiencyStatus"),
        )
        .limit(k)
    )


def alerts(health: DataFrame, building_type=None, hvac_system=None, k: int = 5) -> DataFrame:
    """Severity (|dev| > 50 critical, > 20 warning, else info) and message per alert."""
    top = largest_deviations(health, building_type, hvac_system, k)
    a = F.abs("DeviationPercent")
    sev = F.when(a > 50, F.lit("critical")).when(a > 20, F.lit("warning")).otherwise(F.lit("info"))
    return top.select(
        F.col(B).alias("buildingType"),
        F.col(H).alias("hvacSystem"),
        sev.alias("severity"),
        deviation_message("DeviationPercent").alias("message"),
    )
