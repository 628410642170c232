"""Queries for the cleaning operators, features and consumption aggregates."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from joulebox.plans import readings as R
from joulebox.plans import states
from joulebox.queries import sql as S
from joulebox.operators.quantiles import iqr_bounds
from joulebox.registry import ORACLES, memo, register
from joulebox.schema import OUTLIER_COLUMNS
from joulebox.session import scratch_path, stage_table
from joulebox.sources import testdata

# Oracle-checked queries use exact quartiles so DuckDB's quantile_cont can match.
IQR_MODE = "exact"


def _counted_and_extremes(spark: SparkSession, sf: str):
    return memo(spark, ("counted", sf), lambda: R.stage_counted(R.counted_readings(testdata.loose_readings(spark, sf))))


def counted(spark: SparkSession, sf: str):
    """Distinct prepared readings with multiplicity, stored once per session under the checkpoint folder."""
    return _counted_and_extremes(spark, sf)[0]


def staged(spark: SparkSession, sf: str):
    """Rows that reach the IQR rule."""
    return R.before_outliers(None, counted=counted(spark, sf))


def bounds(spark: SparkSession, sf: str) -> dict:
    """IQR bounds for the readings of ``sf`` (a handful of literals, memoised per session)."""
    extremes = _counted_and_extremes(spark, sf)[1]
    return memo(spark, ("iqr", sf), lambda: iqr_bounds(staged(spark, sf), OUTLIER_COLUMNS, mode=IQR_MODE, extremes=extremes))


def clean(spark: SparkSession, sf: str):
    """clean_readings over the staged counted rows with the memoised bounds."""
    return R.clean_readings(None, bounds=bounds(spark, sf), counted=counted(spark, sf))


def features(spark: SparkSession, sf: str):
    return R.add_features(clean(spark, sf))


@register("clean_readings", S.with_features("SELECT * EXCLUDE (EnergyPerArea, TemperatureDifference) FROM features"))
def q_clean_readings(spark, sf):
    return clean(spark, sf)


@register("features", S.with_features("SELECT * FROM features"))
def q_features(spark, sf):
    return features(spark, sf)


@register(
    "energy_by_building",
    S.with_features(
        """SELECT BuildingType, count(*) AS RecordCount, round(avg(EnergyConsumption), 2) AS AverageEnergy,
       round(sum(EnergyConsumption), 2) AS TotalEnergy, round(avg(EnergyPerArea), 4) AS AverageEnergyPerArea
FROM features GROUP BY BuildingType"""
    ),
)
def q_energy_by_building(spark, sf):
    return R.by_building(features(spark, sf))


#: What stands for the day of a reading, which the loose readings lack.
PART_OF = "NumberofAppliances"
BATCHES = 3


def stored_states(spark: SparkSession, sf: str):
    """The energy states of the readings, added in three batches; then a batch is added again and a part replaced."""

    def store() -> str:
        feats = stage_table(features(spark, sf), "features")
        path = scratch_path(spark, f"states-{uuid.uuid4().hex[:12]}")
        batch = F.pmod(F.xxhash64("RoomArea"), F.lit(BATCHES))
        part = F.col(PART_OF)
        for b in [*range(BATCHES), 0]:
            states.add_batch(spark, path, states.energy_states(feats.where(batch == b), part), f"B{b}")
        states.replace_parts(spark, path, states.energy_states(feats.where(part == 7), part), "again")
        return path

    return spark.read.parquet(memo(spark, ("energy-states", sf), store))


def stored_sketches(spark: SparkSession, sf: str):
    """Quantile sketches of the readings' numbers, added in three batches."""

    def store() -> str:
        feats = stage_table(features(spark, sf).select(*APPROX_COLUMNS), "features")
        path = scratch_path(spark, f"sketches-{uuid.uuid4().hex[:12]}")
        for b in range(BATCHES):
            rows = feats.where(F.pmod(F.xxhash64("RoomArea"), F.lit(BATCHES)) == b)
            states.add_batch(spark, path, states.sketches(rows, F.lit("all"), APPROX_COLUMNS), f"B{b}")
        return path

    return spark.read.parquet(memo(spark, ("sketches", sf), store))


def prepared(spark: SparkSession, sf: str):
    return R.prepare_readings(testdata.loose_readings(spark, sf))


def with_prep(select: str) -> str:
    return "WITH " + ",".join([S.LOOSE, S.PREP]) + "\n" + select


def with_dedup(select: str) -> str:
    return "WITH " + ",".join([S.LOOSE, S.PREP, S.DEDUP]) + "\n" + select


@register(
    "rename",
    f"""WITH {S.LOOSE.strip()}
SELECT RoomArea, NumberofAppliances, "Outside Temperature" AS OutsideTemperature, InsulationThickness, BuildingType,
       HVACSystem, AverageTemperature, EnergyConsumption FROM loose""",
)
def q_rename(spark, sf):
    from joulebox.operators.cleaning import rename_columns

    return rename_columns(testdata.loose_readings(spark, sf), R.RENAMES)


@register(
    "nonfinite_to_null",
    with_prep(
        "SELECT RoomArea, NumberofAppliances, OutsideTemperature, InsulationThickness, AverageTemperature, "
        "EnergyConsumption FROM prep"
    ),
)
def q_nonfinite_to_null(spark, sf):
    return prepared(spark, sf).select(*NUMERIC)


@register(
    "cast_numeric",
    with_prep("SELECT RoomArea, NumberofAppliances, typeof(RoomArea) AS area_type, typeof(NumberofAppliances) AS count_type FROM prep"),
)
def q_cast_numeric(spark, sf):
    from pyspark.sql import functions as F

    p = prepared(spark, sf)
    return p.select(
        "RoomArea",
        "NumberofAppliances",
        F.upper(F.typeof("RoomArea")).alias("area_type"),
        F.regexp_replace(F.upper(F.typeof("NumberofAppliances")), "^INT$", "INTEGER").alias("count_type"),
    )


@register(
    "fn_floor",
    "SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice / 100) AS INTEGER) AS price_hundreds FROM lineitem",
)
def q_fn_floor(spark, sf):
    from pyspark.sql import functions as F

    from joulebox.functions.numeric import floor_int

    li = testdata.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", floor_int(F.col("l_extendedprice") / 100).alias("price_hundreds"))


@register(
    "normalize_category",
    f"""WITH {S.LOOSE.strip()}
SELECT DISTINCT BuildingType AS raw_building, {S.initcap_word('BuildingType')} AS BuildingType,
       HVACSystem AS raw_hvac, {S.hvac_fix('HVACSystem')} AS HVACSystem FROM loose""",
)
def q_normalize_category(spark, sf):
    from pyspark.sql import functions as F

    from joulebox.operators.cleaning import normalize_categories

    loose = testdata.loose_readings(spark, sf).select(
        "BuildingType", "HVACSystem", F.col("BuildingType").alias("raw_building"), F.col("HVACSystem").alias("raw_hvac")
    )
    return normalize_categories(loose).distinct()


@register(
    "fn_trim_initcap",
    f"SELECT p_partkey, {S.initcap_word('p_name')} AS name_title, trim(p_brand) AS brand FROM part",
)
def q_fn_trim_initcap(spark, sf):
    from pyspark.sql import functions as F

    from joulebox.functions.categories import normalize_category

    part = testdata.table(spark, sf, "part")
    return part.select("p_partkey", normalize_category("p_name").alias("name_title"), F.trim("p_brand").alias("brand"))


NUMERIC = ["RoomArea", "NumberofAppliances", "OutsideTemperature", "InsulationThickness", "AverageTemperature", "EnergyConsumption"]
ALL8 = NUMERIC[:4] + ["BuildingType", "HVACSystem"] + NUMERIC[4:]


@register(
    "null_counts",
    with_prep("SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in ALL8) + " FROM prep"),
)
def q_null_counts(spark, sf):
    from joulebox.operators.cleaning import null_counts

    return null_counts(prepared(spark, sf), ALL8)


@register("dedup_rows", with_dedup("SELECT * FROM dedup"))
def q_dedup_rows(spark, sf):
    from joulebox.operators.dedup import dedup_rows

    return dedup_rows(prepared(spark, sf))


@register("drop_missing", with_dedup(f"SELECT * FROM dedup WHERE {S.COMPLETE}"))
def q_drop_missing(spark, sf):
    from joulebox.operators.cleaning import drop_missing
    from joulebox.operators.dedup import dedup_rows

    return drop_missing(dedup_rows(prepared(spark, sf)), ALL8)


@register(
    "fill_missing",
    with_prep(
        f"""SELECT {S.nz('RoomArea', '0.0')} AS RoomArea, coalesce(NumberofAppliances, 0) AS NumberofAppliances,
       {S.nz('OutsideTemperature', '0.0')} AS OutsideTemperature, {S.nz('InsulationThickness', '0.0')} AS InsulationThickness,
       coalesce(BuildingType, 'Unknown') AS BuildingType, coalesce(HVACSystem, 'Unknown') AS HVACSystem,
       {S.nz('AverageTemperature', '0.0')} AS AverageTemperature, {S.nz('EnergyConsumption', '0.0')} AS EnergyConsumption
FROM prep"""
    ),
)
def q_fill_missing(spark, sf):
    from joulebox.operators.cleaning import fill_missing
    from joulebox.plans.medallion import CATEGORY_DEFAULTS, NUMERIC_DEFAULTS

    return fill_missing(prepared(spark, sf), NUMERIC_DEFAULTS, CATEGORY_DEFAULTS)


@register("filter_compare", with_dedup(f"SELECT * FROM dedup WHERE {S.COMPLETE} AND {S.VALID_NUMBERS}"))
def q_filter_compare(spark, sf):
    from joulebox.operators.cleaning import drop_missing, valid_numbers
    from joulebox.operators.dedup import dedup_rows

    return drop_missing(dedup_rows(prepared(spark, sf)), ALL8).filter(valid_numbers())


@register("filter_between", with_dedup(f"SELECT * FROM dedup WHERE {S.COMPLETE} AND {S.VALID_TEMPS}"))
def q_filter_between(spark, sf):
    from joulebox.operators.cleaning import drop_missing, valid_temperatures
    from joulebox.operators.dedup import dedup_rows

    return drop_missing(dedup_rows(prepared(spark, sf)), ALL8).filter(valid_temperatures())


@register(
    "filter_in",
    f"""WITH {S.RAW.strip()}
SELECT RecordID, ReadingDate FROM raw WHERE dayofweek(CAST(ReadingDate AS DATE)) + 1 IN (1, 7)""",
)
def q_filter_in(spark, sf):
    from pyspark.sql import functions as F

    from joulebox.functions.dates import parse_date
    from joulebox.operators.cleaning import filter_in

    raw = testdata.raw_readings(spark, sf).withColumn("weekday", F.dayofweek(parse_date("ReadingDate")))
    return filter_in(raw, "weekday", [1, 7]).select("RecordID", "ReadingDate")


SCOPE_COLS = "BuildingType, HVACSystem, RoomArea, EnergyConsumption, EnergyPerArea"


@register("filter_sentinel", S.with_features(f"SELECT {SCOPE_COLS} FROM features WHERE {S.SCOPE}"))
def q_filter_sentinel(spark, sf):
    from joulebox.operators.cleaning import exclude_sentinel

    return exclude_sentinel(features(spark, sf), ["BuildingType", "HVACSystem"]).select(*SCOPE_COLS.split(", "))


@register(
    "filter_optional",
    S.with_features(f"SELECT {SCOPE_COLS} FROM features WHERE {S.SCOPE} AND BuildingType = 'Large' AND HVACSystem = 'VRF'"),
)
def q_filter_optional(spark, sf):
    from joulebox.plans.reports import scoped

    return scoped(features(spark, sf), building_type="Large", hvac_system="VRF").select(*SCOPE_COLS.split(", "))


@register("project", S.with_features(f"SELECT {SCOPE_COLS} FROM features"))
def q_project(spark, sf):
    return features(spark, sf).select(*SCOPE_COLS.split(", "))


@register("distinct", S.with_features("SELECT DISTINCT BuildingType FROM features"))
def q_distinct(spark, sf):
    return features(spark, sf).select("BuildingType").distinct()


EVENT_IQR = """WITH b AS (
  SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events
)
SELECT events.* FROM events CROSS JOIN b WHERE value BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1)"""


@register("iqr_filter", EVENT_IQR)
def q_iqr_filter(spark, sf):
    from joulebox.operators.quantiles import iqr_filter

    ev = testdata.events(spark, sf)
    return iqr_filter(ev, ["value"], 3.0, mode="exact")


@register(
    "quantiles",
    S.with_features(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS probability, quantile_cont({c}, {p}) AS value FROM features"""
            for c in ["RoomArea", "NumberofAppliances", "EnergyConsumption"]
            for p in (0.1, 0.25, 0.75, 0.9)
        )
    ),
)
def q_quantiles(spark, sf):
    from joulebox.operators.quantiles import quantile_table

    return quantile_table(features(spark, sf), ["RoomArea", "NumberofAppliances", "EnergyConsumption"], [0.1, 0.25, 0.75, 0.9], mode="exact")


APPROX_COLUMNS, APPROX_PROBS = ["RoomArea", "NumberofAppliances", "EnergyConsumption"], [0.1, 0.25, 0.75, 0.9]


@register(
    "quantiles_approx",
    S.with_features(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS probability, count({c}) AS n, TRUE AS within FROM features"""
            for c in APPROX_COLUMNS
            for p in APPROX_PROBS
        )
    ),
)
def q_quantiles_approx(spark, sf):
    """The default mode: whether each approximate quantile's rank is within the relative error of 0.01."""
    from joulebox.operators.quantiles import quantile_table

    feats = features(spark, sf)
    return within(feats, quantile_table(feats, APPROX_COLUMNS, APPROX_PROBS, rel_error=0.01))


def within(feats, got):
    """Whether each quantile of ``got`` (column, probability, value) has a rank in ``feats`` within 0.01 of its probability."""
    ranks = feats.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in APPROX_COLUMNS])).alias("e")).select("e.*")
    # bounded: one row per quantile; joined by a shuffle, all rows of a column would go to one task
    counted = ranks.join(F.broadcast(got), "column").groupBy("column", "probability").agg(
        F.count("x").alias("n"), F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("upto")
    )
    wanted, slack = F.col("probability") * F.col("n"), F.col("n") * 0.01 + 1
    return counted.select("column", "probability", "n", ((F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)).alias("within"))


@register(
    "quantiles_sketched",
    S.with_features(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS probability, count({c}) AS n, TRUE AS within FROM features"""
            for c in APPROX_COLUMNS
            for p in APPROX_PROBS
        )
    ),
)
def q_quantiles_sketched(spark, sf):
    """Quantiles from sketches that three batches left, merged without reading the readings again: their ranks, too."""
    return within(features(spark, sf), states.sketched_quantiles(stored_sketches(spark, sf), APPROX_PROBS))


@register(
    "stage_counts",
    "WITH "
    + ",".join([S.LOOSE, S.PREP, S.DEDUP, S.VALID, S.BOUNDS, S.CLEAN])
    + f"""
SELECT (SELECT count(*) FROM prep) AS raw_records,
       (SELECT count(*) FROM prep) - (SELECT count(*) FROM dedup) AS duplicates_removed,
       (SELECT count(*) FROM dedup WHERE NOT ({S.COMPLETE})) AS missing_removed,
       (SELECT count(*) FROM dedup WHERE {S.COMPLETE} AND NOT ({S.VALID_NUMBERS})) AS invalid_removed,
       (SELECT count(*) FROM dedup WHERE {S.COMPLETE} AND {S.VALID_NUMBERS} AND NOT ({S.VALID_TEMPS})) AS temperature_removed,
       (SELECT count(*) FROM valid) - (SELECT count(*) FROM clean) AS outliers_removed,
       (SELECT count(*) FROM clean) AS clean_records,
       {S.rnd('(SELECT count(*) FROM clean) / (SELECT count(*) FROM prep)', 6)} AS retention_rate""",
)
def q_stage_counts(spark, sf):
    return R.stage_report(None, counted=counted(spark, sf), bounds=bounds(spark, sf))


@register(
    "energy_statistics",
    S.with_model("SELECT * FROM stats"),
)
def q_energy_statistics(spark, sf):
    return R.statistics(features(spark, sf))


@register("energy_by_hvac", S.with_model("SELECT * FROM by_hvac"))
def q_energy_by_hvac(spark, sf):
    return R.by_hvac(features(spark, sf))


@register(
    "topk_efficiency",
    S.with_features(
        f"SELECT {SCOPE_COLS} FROM features ORDER BY EnergyPerArea DESC, BuildingType, HVACSystem, RoomArea, EnergyConsumption LIMIT 10"
    ),
)
def q_topk_efficiency(spark, sf):
    return R.top_efficiency(features(spark, sf))


@register("energy_by_building__states", ORACLES["energy_by_building"])
def q_energy_by_building_states(spark, sf):
    return states.energy_by(stored_states(spark, sf), "BuildingType")


@register("energy_by_hvac__states", ORACLES["energy_by_hvac"])
def q_energy_by_hvac_states(spark, sf):
    return states.energy_by(stored_states(spark, sf), "HVACSystem")


@register("energy_statistics__states", ORACLES["energy_statistics"])
def q_energy_statistics_states(spark, sf):
    return states.energy_statistics(stored_states(spark, sf))
