"""Reading clean-up, features and the consumption aggregates (the first pipeline).

Everything here is lazy: each function returns a DataFrame whose plan Catalyst
collapses into a few stages (one shuffle for the full-row dedup, one per
aggregate). The only eager work is the exact-quantile selection when
``iqr_mode="exact"`` is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joulebox.operators.aggregates import energy_by, energy_statistics
from joulebox.operators.cleaning import (
    all_present,
    cast_readings,
    normalize_categories,
    rename_columns,
    valid_numbers,
    valid_temperatures,
)
from joulebox.operators.dedup import dedup_rows_counted
from joulebox.operators.quantiles import extreme_metrics, iqr_bounds, iqr_condition
from joulebox.operators.topk import top_k
from joulebox.schema import NUMERIC_COLUMNS, OUTLIER_COLUMNS, REQUIRED_COLUMNS
from joulebox.session import stage_table, stage_table_observed

RENAMES = {"Outside Temperature": "OutsideTemperature"}
COPIES = "_copies"


def prepare_readings(raw: DataFrame, null_tokens=("",)) -> DataFrame:
    """rename -> non-finite to NULL + double casts -> floor appliances -> categories."""
    df = rename_columns(raw, RENAMES)
    df = cast_readings(df, NUMERIC_COLUMNS, ["NumberofAppliances"])
    return normalize_categories(df, null_tokens=null_tokens)


def counted_readings(raw: DataFrame, null_tokens=("",)) -> DataFrame:
    """Prepared distinct rows with their multiplicity (``_copies``): the one
    dedup aggregation both the cleaned rows and the stage report come from."""
    return dedup_rows_counted(prepare_readings(raw, null_tokens), COPIES)


def passes_rules() -> F.Column:
    """Complete, valid numbers, temperatures in range (everything before the IQR rule)."""
    return all_present(REQUIRED_COLUMNS) & valid_numbers() & valid_temperatures()


def stage_counted(counted: DataFrame) -> tuple[DataFrame, dict]:
    """Write the counted rows once under the checkpoint folder; the same write
    observes count/min/max of the IQR columns over the rule-passing rows, which
    the exact quantile selection would otherwise spend a pass on."""
    staged, metrics = stage_table_observed(counted, "counted-readings", extreme_metrics(OUTLIER_COLUMNS, passes_rules()))
    return staged, metrics


def before_outliers(raw: DataFrame, null_tokens=("",), counted: DataFrame | None = None) -> DataFrame:
    """Everything up to the IQR rule: prepare, full-row dedup, drop missing,
    numeric rules, temperature ranges."""
    counted = counted_readings(raw, null_tokens) if counted is None else counted
    return counted.filter(passes_rules()).drop(COPIES)


def outlier_bounds(
    raw: DataFrame, iqr_mode: str = "approx", iqr_factor: float = 3.0, rel_error: float = 0.01, null_tokens=("",)
) -> dict:
    """IQR bounds (literal Columns) computed on the rows that reach the IQR rule."""
    return iqr_bounds(before_outliers(raw, null_tokens), OUTLIER_COLUMNS, iqr_factor, iqr_mode, rel_error)


def clean_readings(
    raw: DataFrame,
    iqr_mode: str = "approx",
    iqr_factor: float = 3.0,
    rel_error: float = 0.01,
    null_tokens=("",),
    bounds: dict | None = None,
    stage: bool = True,
    counted: DataFrame | None = None,
) -> DataFrame:
    """The full cleaning order: prepare, full-row dedup, drop missing, numeric
    rules, temperature ranges, then the IQR rule on area, appliances and energy
    (bounds from the rows that passed everything before it; pass ``bounds`` to
    reuse ones already computed for the same input).

    With ``stage`` the deduped rows are written once under the shared
    checkpoint folder, so the quantile pass and the final filter read them
    instead of recomputing the scan, join and dedup shuffle. ``counted`` (from
    ``counted_readings``, possibly staged) skips that step altogether.
    """
    extremes = None
    if counted is None:
        counted = counted_readings(raw, null_tokens)
        if stage and bounds is None:
            counted, extremes = stage_counted(counted)
    df = before_outliers(raw, null_tokens, counted)
    if bounds is None:
        bounds = iqr_bounds(df, OUTLIER_COLUMNS, iqr_factor, iqr_mode, rel_error, extremes if iqr_mode == "exact" else None)
    cond = iqr_condition(bounds)
    return df if cond is None else df.filter(cond)


def stage_report(
    raw: DataFrame,
    iqr_mode: str = "approx",
    iqr_factor: float = 3.0,
    rel_error: float = 0.01,
    null_tokens=("",),
    counted: DataFrame | None = None,
    bounds: dict | None = None,
) -> DataFrame:
    """One row of rows-removed-per-stage in a single tagged pass.

    The dedup keeps each distinct row's multiplicity, so raw and duplicate
    counts come from the same aggregation as the rule counts (the original
    ran ten separate counts, each re-reading the input). Pass the ``counted``
    frame and ``bounds`` used for ``clean_readings`` to share their work.
    """
    if counted is None:
        counted = stage_table(counted_readings(raw, null_tokens), "stage-counts")
    if bounds is None:
        bounds = iqr_bounds(before_outliers(raw, null_tokens, counted), OUTLIER_COLUMNS, iqr_factor, iqr_mode, rel_error)
    complete = all_present(REQUIRED_COLUMNS)
    keep = iqr_condition(bounds)
    keep = F.lit(True) if keep is None else keep
    reason = (
        F.when(~complete, F.lit("missing"))
        .when(~valid_numbers(), F.lit("invalid"))
        .when(~valid_temperatures(), F.lit("temperature"))
        .when(~keep, F.lit("outlier"))
        .otherwise(F.lit("clean"))
    )
    tagged = counted.withColumn("_reason", reason)
    raw_n = F.sum(COPIES)
    clean_n = F.count_if(F.col("_reason") == "clean")
    return tagged.agg(
        raw_n.alias("raw_records"),
        (raw_n - F.count(F.lit(1))).alias("duplicates_removed"),
        F.count_if(F.col("_reason") == "missing").alias("missing_removed"),
        F.count_if(F.col("_reason") == "invalid").alias("invalid_removed"),
        F.count_if(F.col("_reason") == "temperature").alias("temperature_removed"),
        F.count_if(F.col("_reason") == "outlier").alias("outliers_removed"),
        clean_n.alias("clean_records"),
        F.round(F.try_divide(clean_n.cast("double"), raw_n.cast("double")), 6).alias("retention_rate"),
    )


def clean_with_report(
    raw: DataFrame, iqr_mode: str = "approx", iqr_factor: float = 3.0, rel_error: float = 0.01, null_tokens=("",)
) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows, stage report) from one staged dedup and one set of bounds."""
    counted, extremes = stage_counted(counted_readings(raw, null_tokens))
    pre = before_outliers(raw, null_tokens, counted)
    bounds = iqr_bounds(pre, OUTLIER_COLUMNS, iqr_factor, iqr_mode, rel_error, extremes if iqr_mode == "exact" else None)
    clean = clean_readings(raw, bounds=bounds, counted=counted)
    return clean, stage_report(raw, counted=counted, bounds=bounds)


def add_features(df: DataFrame) -> DataFrame:
    """EnergyPerArea = round(E / area, 4); TemperatureDifference = round(avg - outside, 4)."""
    return df.withColumns(
        {
            "EnergyPerArea": F.round(F.try_divide(F.col("EnergyConsumption"), F.col("RoomArea")), 4),
            "TemperatureDifference": F.round(F.col("AverageTemperature") - F.col("OutsideTemperature"), 4),
        }
    )


def statistics(features: DataFrame) -> DataFrame:
    return energy_statistics(features)


def by_building(features: DataFrame) -> DataFrame:
    return energy_by(features, "BuildingType")


def by_hvac(features: DataFrame) -> DataFrame:
    return energy_by(features, "HVACSystem")


def top_efficiency(features: DataFrame, k: int = 10) -> DataFrame:
    """k rows with the highest EnergyPerArea (ties broken by the other columns)."""
    cols = ["BuildingType", "HVACSystem", "RoomArea", "EnergyConsumption", "EnergyPerArea"]
    return top_k(features.select(*cols), [F.col("EnergyPerArea").desc()], k)
