"""Queries for the report surface (and the operators each report is built from)."""

from __future__ import annotations

from pyspark.sql import functions as F

from joulebox.operators.joins import lookup_with_default
from joulebox.plans import readings as R
from joulebox.plans import reports as P
from joulebox.queries import q_cleaning, q_model
from joulebox.queries import sql as S
from joulebox.registry import ORACLES, register
from joulebox.schema import STATUS_ABOVE

ABOVE = "'Inefficient (Above Expected)'"


def feats(spark, sf):
    return q_cleaning.features(spark, sf)


def health(spark, sf):
    return q_model.health(spark, sf)


@register(
    "report_filters",
    S.with_features(
        """SELECT DISTINCT 'buildingType' AS kind, BuildingType AS value FROM features WHERE BuildingType <> 'Nan'
UNION ALL SELECT DISTINCT 'hvacSystem' AS kind, HVACSystem AS value FROM features WHERE HVACSystem <> 'Nan'
ORDER BY 1, 2"""
    ),
)
def q_report_filters(spark, sf):
    return P.filters(feats(spark, sf))


@register(
    "sort_position",
    S.with_features("SELECT DISTINCT BuildingType FROM features WHERE BuildingType <> 'Nan' ORDER BY 1"),
)
def q_sort_position(spark, sf):
    return feats(spark, sf).select("BuildingType").filter(F.col("BuildingType") != "Nan").distinct().orderBy(F.col("BuildingType"))


KPIS = S.with_model(
    f"""SELECT t.*, h.* FROM
 (SELECT coalesce(sum(EnergyConsumption), 0.0) AS total_energy, coalesce(avg(EnergyPerArea), 0.0) AS avg_energy_per_area,
         count(DISTINCT BuildingType) AS building_types FROM features WHERE {S.SCOPE}) t,
 (SELECT coalesce(avg({S.clamp_score()}), 0.0) AS avg_health_score,
         count(*) FILTER (WHERE EfficiencyStatus = {ABOVE}) AS at_risk_count, count(*) AS total_records
  FROM health WHERE {S.SCOPE}) h"""
)


@register("report_kpis", KPIS)
def q_report_kpis(spark, sf):
    return P.kpis(feats(spark, sf), health(spark, sf))


@register(
    "agg_count_distinct",
    S.with_features(f"SELECT count(DISTINCT BuildingType) AS building_types FROM features WHERE {S.SCOPE}"),
)
def q_agg_count_distinct(spark, sf):
    return P.scoped(feats(spark, sf)).agg(F.count_distinct("BuildingType").alias("building_types"))


@register(
    "agg_conditional",
    S.with_model(
        f"""SELECT CAST(sum(CASE WHEN EfficiencyStatus = {ABOVE} THEN 1 ELSE 0 END) AS BIGINT) AS at_risk_count
FROM health WHERE {S.SCOPE}"""
    ),
)
def q_agg_conditional(spark, sf):
    above = F.when(F.col("EfficiencyStatus") == "Inefficient (Above Expected)", 1).otherwise(0)
    return P.scoped(health(spark, sf)).agg(F.sum(above).cast("bigint").alias("at_risk_count"))


@register(
    "agg_clamped_avg",
    S.with_model(
        f"SELECT BuildingType, avg({S.clamp_score()}) AS health_score FROM health WHERE {S.SCOPE} GROUP BY BuildingType"
    ),
)
def q_agg_clamped_avg(spark, sf):
    return P.type_health(health(spark, sf)).select("BuildingType", "health_score")


@register(
    "report_energy_by_type",
    S.with_model(
        "SELECT BuildingType AS name, TotalEnergy AS value FROM by_building WHERE BuildingType <> 'Nan' ORDER BY value DESC"
    ),
)
def q_report_energy_by_type(spark, sf):
    f = feats(spark, sf)
    return P.energy_by_type(f, R.by_building(f))


@register(
    "report_energy_by_type_filtered",
    S.with_model(
        f"""SELECT BuildingType AS name, sum(EnergyConsumption) AS value FROM features
WHERE {S.SCOPE} AND HVACSystem = 'VRF' GROUP BY BuildingType ORDER BY value DESC"""
    ),
)
def q_report_energy_by_type_filtered(spark, sf):
    f = feats(spark, sf)
    return P.energy_by_type(f, R.by_building(f), hvac_system="VRF")


@register(
    "sort_agg",
    S.with_features(
        f"""SELECT BuildingType AS name, sum(EnergyConsumption) AS value FROM features
WHERE {S.SCOPE} GROUP BY BuildingType ORDER BY value DESC"""
    ),
)
def q_sort_agg(spark, sf):
    f = P.scoped(feats(spark, sf))
    return f.groupBy(F.col("BuildingType").alias("name")).agg(F.sum("EnergyConsumption").alias("value")).orderBy(F.desc("value"))


@register(
    "report_energy_by_hvac",
    S.with_model("SELECT HVACSystem AS name, TotalEnergy AS value FROM by_hvac WHERE HVACSystem <> 'Nan' ORDER BY value DESC"),
)
def q_report_energy_by_hvac(spark, sf):
    f = feats(spark, sf)
    return P.energy_by_hvac(f, R.by_hvac(f))


@register(
    "report_energy_by_hvac_filtered",
    S.with_model(
        f"""SELECT HVACSystem AS name, sum(EnergyConsumption) AS value FROM features
WHERE {S.SCOPE} AND BuildingType = 'Large' GROUP BY HVACSystem ORDER BY value DESC"""
    ),
)
def q_report_energy_by_hvac_filtered(spark, sf):
    f = feats(spark, sf)
    return P.energy_by_hvac(f, R.by_hvac(f), building_type="Large")


@register(
    "report_stats",
    S.with_model(
        """SELECT AverageEnergy AS averageEnergy, MaximumEnergy AS maximumEnergy, MinimumEnergy AS minimumEnergy,
       TotalEnergy AS totalEnergy, TotalRecords AS totalRecords FROM stats"""
    ),
)
def q_report_stats(spark, sf):
    return P.stats_summary(R.statistics(feats(spark, sf)))


HEALTH_DIST = f"""SELECT CASE WHEN EfficiencyStatus = {ABOVE} AND DeviationPercent > 50 THEN 'Critical'
            WHEN EfficiencyStatus = {ABOVE} THEN 'Warning' ELSE 'Healthy' END AS name, count(*) AS value
FROM health WHERE {S.SCOPE} GROUP BY 1"""


@register("report_health_distribution", S.with_model(HEALTH_DIST))
def q_report_health_distribution(spark, sf):
    return P.health_distribution(health(spark, sf))


@register("agg_group_by_expr", S.with_model(HEALTH_DIST))
def q_agg_group_by_expr(spark, sf):
    return P.health_distribution(health(spark, sf))


@register(
    "report_health_share",
    S.with_model(
        f"""SELECT name, value, CAST(round(value * 100.0 / sum(value) OVER (), 0) AS INTEGER) AS percent
FROM ({HEALTH_DIST})"""
    ),
)
def q_report_health_share(spark, sf):
    return P.health_share(health(spark, sf))


VS_AREA = S.with_features(
    f"SELECT RoomArea AS area, EnergyConsumption AS energy FROM features WHERE {S.SCOPE} ORDER BY area, energy LIMIT 200"
)


@register("report_energy_vs_area", VS_AREA)
def q_report_energy_vs_area(spark, sf):
    return P.energy_vs_area(feats(spark, sf))


@register("sorted_sample", VS_AREA)
def q_sorted_sample(spark, sf):
    return P.energy_vs_area(feats(spark, sf))


@register(
    "report_epa_by_type",
    S.with_features(
        f"SELECT BuildingType AS name, avg(EnergyPerArea) AS value FROM features WHERE {S.SCOPE} GROUP BY 1 ORDER BY value DESC"
    ),
)
def q_report_epa_by_type(spark, sf):
    return P.epa_by_type(feats(spark, sf))


SERIES = S.with_model(
    f"""SELECT CAST(row_number() OVER (ORDER BY actual, predicted) AS INTEGER) AS index, actual, predicted FROM
 (SELECT EnergyConsumption AS actual, prediction AS predicted FROM pred WHERE {S.SCOPE}
  ORDER BY actual, predicted LIMIT 100)"""
)


@register("report_predictions", SERIES)
def q_report_predictions(spark, sf):
    return P.prediction_series(q_model.predictions(spark, sf))


@register("limit_any", SERIES)
def q_limit_any(spark, sf):
    return P.prediction_series(q_model.predictions(spark, sf))


@register(
    "accuracy_report",
    S.with_model(
        f"""SELECT coalesce(avg(abs(EnergyConsumption - prediction)), 0.0) AS mae,
       coalesce(sqrt(avg((EnergyConsumption - prediction) * (EnergyConsumption - prediction))), 0.0) AS rmse,
       coalesce(avg(abs((EnergyConsumption - prediction)
                / CASE WHEN EnergyConsumption = 0 THEN 1.0 ELSE EnergyConsumption END)) * 100, 0.0) AS mape,
       CASE WHEN count(*) = 0 OR var_pop(EnergyConsumption) * count(EnergyConsumption) = 0 THEN 0.0
            ELSE 1 - sum((EnergyConsumption - prediction) * (EnergyConsumption - prediction))
                     / (var_pop(EnergyConsumption) * count(EnergyConsumption)) END AS r2
FROM pred WHERE {S.SCOPE}"""
    ),
)
def q_accuracy_report(spark, sf):
    return P.prediction_accuracy(q_model.predictions(spark, sf))


TOP_GROUP = f"""SELECT BuildingType, sum(EnergyConsumption) AS total_energy, avg(EnergyPerArea) AS avg_epa
FROM features WHERE {S.SCOPE} GROUP BY BuildingType ORDER BY total_energy DESC, BuildingType LIMIT 5"""


@register("topk_group", S.with_features(TOP_GROUP))
def q_topk_group(spark, sf):
    return P.top_energy_types(feats(spark, sf))


TOP_TYPES = S.with_model(
    f"""SELECT t.BuildingType AS buildingType, CAST(round(t.total_energy, 0) AS BIGINT) AS totalEnergy,
       {S.rnd('t.avg_epa', 1)} AS energyPerArea,
       CAST(round(CASE WHEN h.health_score IS NULL OR h.health_score = 0 THEN 75.0 ELSE h.health_score END, 0) AS BIGINT)
         AS healthScore,
       CASE WHEN coalesce(h.critical_cnt, 0) > 0 THEN 'High' WHEN coalesce(h.warning_cnt, 0) > 0 THEN 'Medium'
            ELSE 'Low' END AS riskLevel
FROM ({TOP_GROUP}) t LEFT JOIN (
  SELECT BuildingType, avg({S.clamp_score()}) AS health_score,
         count(*) FILTER (WHERE EfficiencyStatus = {ABOVE} AND DeviationPercent > 50) AS critical_cnt,
         count(*) FILTER (WHERE EfficiencyStatus = {ABOVE} AND DeviationPercent <= 50) AS warning_cnt
  FROM health WHERE {S.SCOPE} GROUP BY BuildingType) h ON t.BuildingType = h.BuildingType"""
)


@register("report_top_types", TOP_TYPES)
def q_report_top_types(spark, sf):
    return P.top_types(feats(spark, sf), health(spark, sf))


@register(
    "join_lookup_default",
    S.with_model(
        f"""SELECT b.BuildingType, b.RecordCount, coalesce(h.critical_cnt, 0) AS critical_cnt
FROM by_building b LEFT JOIN (SELECT BuildingType, count(*) AS critical_cnt FROM health
  WHERE EfficiencyStatus = {ABOVE} AND DeviationPercent > 400 GROUP BY BuildingType) h ON b.BuildingType = h.BuildingType"""
    ),
)
def q_join_lookup_default(spark, sf):
    """Types with their number of extreme deviations, 0 where the lookup has no row."""
    extreme = health(spark, sf).filter((F.col("EfficiencyStatus") == STATUS_ABOVE) & (F.col("DeviationPercent") > 400))
    found = extreme.groupBy("BuildingType").agg(F.count(F.lit(1)).alias("critical_cnt"))
    types = R.by_building(feats(spark, sf)).select("BuildingType", "RecordCount")
    return lookup_with_default(types, found, "BuildingType", {"critical_cnt": 0})


TOP_ABS = f"""SELECT BuildingType, HVACSystem, DeviationPercent, EfficiencyStatus FROM health WHERE {S.SCOPE}
ORDER BY abs(DeviationPercent) DESC NULLS FIRST, BuildingType, HVACSystem, DeviationPercent NULLS FIRST, EfficiencyStatus
LIMIT 5"""


@register("topk_abs", S.with_model(TOP_ABS))
def q_topk_abs(spark, sf):
    return P.largest_deviations(health(spark, sf))


@register(
    "report_alerts",
    S.with_model(
        f"""SELECT BuildingType AS buildingType, HVACSystem AS hvacSystem,
       CASE WHEN abs(DeviationPercent) > 50 THEN 'critical' WHEN abs(DeviationPercent) > 20 THEN 'warning'
            ELSE 'info' END AS severity,
       printf('Energy consumption is %.1f%% %s than predicted', {S.rnd('abs(DeviationPercent)', 1)},
              CASE WHEN DeviationPercent > 0 THEN 'higher' ELSE 'lower' END) AS message
FROM ({TOP_ABS})"""
    ),
)
def q_report_alerts(spark, sf):
    return P.alerts(health(spark, sf))


# The filtered routes: each report by type, by system, and by both. The oracle is the unfiltered one with the
# filter added to every scope.
FILTERS = {
    "type": {"building_type": "Promo"},
    "hvac": {"hvac_system": "VRF"},
    "both": {"building_type": "Promo", "hvac_system": "VRF"},
}
ROUTES = {
    "report_kpis": lambda spark, sf, **f: P.kpis(feats(spark, sf), health(spark, sf), **f),
    "report_health_distribution": lambda spark, sf, **f: P.health_distribution(health(spark, sf), **f),
    "report_health_share": lambda spark, sf, **f: P.health_share(health(spark, sf), **f),
    "report_energy_vs_area": lambda spark, sf, **f: P.energy_vs_area(feats(spark, sf), **f),
    "report_epa_by_type": lambda spark, sf, **f: P.epa_by_type(feats(spark, sf), **f),
    "report_predictions": lambda spark, sf, **f: P.prediction_series(q_model.predictions(spark, sf), **f),
    "accuracy_report": lambda spark, sf, **f: P.prediction_accuracy(q_model.predictions(spark, sf), **f),
    "report_top_types": lambda spark, sf, **f: P.top_types(feats(spark, sf), health(spark, sf), **f),
    "report_alerts": lambda spark, sf, **f: P.alerts(health(spark, sf), **f),
}


def _filtered_scope(values: dict[str, str]) -> str:
    columns = {"building_type": "BuildingType", "hvac_system": "HVACSystem"}
    return " AND ".join([S.SCOPE, *[f"{columns[k]} = '{v}'" for k, v in values.items()]])


for _route, _make in ROUTES.items():
    for _suffix, _values in FILTERS.items():
        register(f"{_route}__{_suffix}", ORACLES[_route].replace(S.SCOPE, _filtered_scope(_values)))(
            lambda spark, sf, _make=_make, _values=_values: _make(spark, sf, **_values)
        )
