"""DuckDB building blocks for the oracle SQL (the same mapping as
``joulebox.sources.testdata`` and the same cleaning rules as
``joulebox.plans.readings``, written independently in SQL)."""

from __future__ import annotations

# lineitem JOIN part -> loose raw readings (F1 shape)
LOOSE = """
loose AS (
  SELECT p_size AS RoomArea,
         l_quantity AS NumberofAppliances,
         l_tax * 1500 - 55 AS "Outside Temperature",
         l_discount * 100 AS InsulationThickness,
         CASE WHEN l_linenumber = 7 THEN 'NaN' WHEN l_linenumber = 6 THEN ''
              ELSE concat(' ', lower(p_type)) END AS BuildingType,
         CASE WHEN l_returnflag = 'A' THEN 'central ac' WHEN l_returnflag = 'N' THEN 'no hvac'
              ELSE 'vrf' END AS HVACSystem,
         p_retailprice - 925 AS AverageTemperature,
         CASE WHEN l_linenumber = 5 AND l_quantity < 5 THEN 'NaN'::DOUBLE
              WHEN l_linenumber = 4 AND l_quantity < 3 THEN -1.0
              ELSE l_extendedprice END AS EnergyConsumption
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

# lineitem JOIN part -> strict raw readings (F2 shape)
RAW = """
raw AS (
  SELECT 'REC-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS RecordID,
         CAST(p_size AS INTEGER) AS RoomArea,
         CAST(l_quantity AS INTEGER) AS NumberofAppliances,
         l_tax * 1500 - 55 AS OutsideTemperature,
         l_discount * 100 AS InsulationThickness,
         CASE WHEN l_linenumber = 7 THEN 'NaN' WHEN l_linenumber = 6 THEN ''
              ELSE concat(' ', lower(p_type)) END AS BuildingType,
         CASE WHEN l_returnflag = 'A' THEN 'central ac' WHEN l_returnflag = 'N' THEN 'no hvac'
              ELSE 'vrf' END AS HVACSystem,
         p_retailprice - 925 AS AverageTemperature,
         CASE WHEN l_linenumber = 5 AND l_quantity < 5 THEN 'NaN'::DOUBLE
              WHEN l_linenumber = 4 AND l_quantity < 3 THEN -1.0
              ELSE l_extendedprice END AS EnergyConsumption,
         strftime(l_shipdate, '%Y-%m-%d') AS ReadingDate,
         'power_consumption_sensor' AS source,
         strftime(l_shipdate, '%Y-%m-%d') || ' 00:00:00' AS ingested_at,
         printf('POWER-BATCH-%04d', (year(l_shipdate) - 1992) * 12 + month(l_shipdate)) AS batch_id
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


def nf(x: str) -> str:
    """Non-finite -> NULL on a double."""
    return f"CASE WHEN isnan(CAST({x} AS DOUBLE)) OR isinf(CAST({x} AS DOUBLE)) THEN NULL ELSE CAST({x} AS DOUBLE) END"


def initcap_word(x: str) -> str:
    """trim -> '' to NULL -> initcap (each space-delimited word capitalised)."""
    words = f"string_split(trim({x}), ' ')"
    cap = f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    return f"CASE WHEN trim({x}) = '' THEN NULL ELSE {cap} END"


def rnd(x: str, n: int) -> str:
    """Spark's round(double, n): half-up on the shortest decimal text of the double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def hvac_fix(x: str) -> str:
    w = initcap_word(x)
    return (
        f"CASE {w} WHEN 'Central Ac' THEN 'Central AC' WHEN 'Split Ac' THEN 'Split AC' "
        f"WHEN 'No Hvac' THEN 'No HVAC' WHEN 'Vrf' THEN 'VRF' ELSE {w} END"
    )


PREP = f"""
prep AS (
  SELECT {nf('RoomArea')} AS RoomArea,
         CAST(floor({nf('NumberofAppliances')}) AS INTEGER) AS NumberofAppliances,
         {nf('"Outside Temperature"')} AS OutsideTemperature,
         {nf('InsulationThickness')} AS InsulationThickness,
         {initcap_word('BuildingType')} AS BuildingType,
         {hvac_fix('HVACSystem')} AS HVACSystem,
         {nf('AverageTemperature')} AS AverageTemperature,
         {nf('EnergyConsumption')} AS EnergyConsumption
  FROM loose
)"""

COMPLETE = (
    "RoomArea IS NOT NULL AND NumberofAppliances IS NOT NULL AND OutsideTemperature IS NOT NULL "
    "AND InsulationThickness IS NOT NULL AND BuildingType IS NOT NULL AND HVACSystem IS NOT NULL "
    "AND AverageTemperature IS NOT NULL AND EnergyConsumption IS NOT NULL"
)
VALID_NUMBERS = "RoomArea > 0 AND EnergyConsumption > 0 AND NumberofAppliances >= 0 AND InsulationThickness >= 0"
VALID_TEMPS = "OutsideTemperature BETWEEN -50 AND 60 AND AverageTemperature BETWEEN -30 AND 50"

DEDUP = "dedup AS (SELECT DISTINCT * FROM prep)"
VALID = f"valid AS (SELECT * FROM dedup WHERE {COMPLETE} AND {VALID_NUMBERS} AND {VALID_TEMPS})"
BOUNDS = """
bounds AS (
  SELECT quantile_cont(RoomArea, 0.25) - 3 * (quantile_cont(RoomArea, 0.75) - quantile_cont(RoomArea, 0.25)) AS ra_lo,
         quantile_cont(RoomArea, 0.75) + 3 * (quantile_cont(RoomArea, 0.75) - quantile_cont(RoomArea, 0.25)) AS ra_hi,
         quantile_cont(NumberofAppliances, 0.25) - 3 * (quantile_cont(NumberofAppliances, 0.75) - quantile_cont(NumberofAppliances, 0.25)) AS na_lo,
         quantile_cont(NumberofAppliances, 0.75) + 3 * (quantile_cont(NumberofAppliances, 0.75) - quantile_cont(NumberofAppliances, 0.25)) AS na_hi,
         quantile_cont(EnergyConsumption, 0.25) - 3 * (quantile_cont(EnergyConsumption, 0.75) - quantile_cont(EnergyConsumption, 0.25)) AS ec_lo,
         quantile_cont(EnergyConsumption, 0.75) + 3 * (quantile_cont(EnergyConsumption, 0.75) - quantile_cont(EnergyConsumption, 0.25)) AS ec_hi
  FROM valid
)"""
IQR_KEEP = (
    "RoomArea BETWEEN ra_lo AND ra_hi AND NumberofAppliances BETWEEN na_lo AND na_hi "
    "AND EnergyConsumption BETWEEN ec_lo AND ec_hi"
)
CLEAN = f"clean AS (SELECT valid.* FROM valid CROSS JOIN bounds WHERE {IQR_KEEP})"
FEATURES = f"""
features AS (
  SELECT *, {rnd('EnergyConsumption / RoomArea', 4)} AS EnergyPerArea,
         {rnd('AverageTemperature - OutsideTemperature', 4)} AS TemperatureDifference
  FROM clean
)"""

# The chain up to the cleaned readings with features.
FEATURE_CHAIN = ",".join([LOOSE, PREP, DEDUP, VALID, BOUNDS, CLEAN, FEATURES])


def with_features(select: str) -> str:
    return f"WITH {FEATURE_CHAIN}\n{select}"


def md5_bucket(key: str, buckets: int = 100) -> str:
    return f"(CAST('0x' || substr(md5({key}), 1, 7) AS BIGINT) % {buckets})"


SPLIT_KEY = (
    "concat_ws('|', CAST(RoomArea AS VARCHAR), CAST(NumberofAppliances AS VARCHAR), "
    "CAST(OutsideTemperature AS VARCHAR), CAST(InsulationThickness AS VARCHAR), BuildingType, HVACSystem, "
    "CAST(AverageTemperature AS VARCHAR), CAST(EnergyConsumption AS VARCHAR))"
)

MODEL = f"""
keyed AS (SELECT *, {md5_bucket(SPLIT_KEY)} < 80 AS is_train FROM features),
train AS (SELECT * EXCLUDE (is_train) FROM keyed WHERE is_train),
test AS (SELECT * EXCLUDE (is_train) FROM keyed WHERE NOT is_train),
coef AS (
  SELECT regr_slope(EnergyConsumption, RoomArea) AS b, regr_intercept(EnergyConsumption, RoomArea) AS a
  FROM keyed WHERE is_train
),
pred AS (
  SELECT EnergyConsumption, a + b * RoomArea AS prediction, BuildingType, HVACSystem, RoomArea,
         NumberofAppliances, InsulationThickness, EnergyPerArea
  FROM keyed CROSS JOIN coef WHERE NOT is_train
),
dev AS (
  SELECT *, {rnd('(EnergyConsumption - prediction) / CASE WHEN prediction <> 0 THEN prediction END * 100', 2)}
         AS DeviationPercent
  FROM pred
),
cuts AS (SELECT quantile_cont(DeviationPercent, 0.1) AS lo, quantile_cont(DeviationPercent, 0.9) AS hi FROM dev),
health AS (
  SELECT BuildingType, HVACSystem, RoomArea, NumberofAppliances, InsulationThickness, EnergyPerArea,
         EnergyConsumption AS ActualEnergy, {rnd('prediction', 2)} AS ExpectedEnergy, DeviationPercent,
         CASE WHEN DeviationPercent >= hi THEN 'Inefficient (Above Expected)'
              WHEN DeviationPercent <= lo THEN 'Highly Efficient (Below Expected)'
              ELSE 'Normal Range' END AS EfficiencyStatus
  FROM dev CROSS JOIN cuts
)"""

AGGS = f"""
by_building AS (
  SELECT BuildingType, count(*) AS RecordCount, {rnd('avg(EnergyConsumption)', 2)} AS AverageEnergy,
         {rnd('sum(EnergyConsumption)', 2)} AS TotalEnergy, {rnd('avg(EnergyPerArea)', 4)} AS AverageEnergyPerArea
  FROM features GROUP BY BuildingType
),
by_hvac AS (
  SELECT HVACSystem, count(*) AS RecordCount, {rnd('avg(EnergyConsumption)', 2)} AS AverageEnergy,
         {rnd('sum(EnergyConsumption)', 2)} AS TotalEnergy, {rnd('avg(EnergyPerArea)', 4)} AS AverageEnergyPerArea
  FROM features GROUP BY HVACSystem
),
stats AS (
  SELECT {rnd('avg(EnergyConsumption)', 2)} AS AverageEnergy, {rnd('min(EnergyConsumption)', 2)} AS MinimumEnergy,
         {rnd('max(EnergyConsumption)', 2)} AS MaximumEnergy, {rnd('sum(EnergyConsumption)', 2)} AS TotalEnergy,
         count(*) AS TotalRecords
  FROM features
)"""

MODEL_CHAIN = ",".join([FEATURE_CHAIN, MODEL, AGGS])


def with_model(select: str) -> str:
    return f"WITH {MODEL_CHAIN}\n{select}"


SCOPE = "BuildingType <> 'Nan' AND HVACSystem <> 'Nan'"


def clamp_score(d: str = "DeviationPercent") -> str:
    return f"CASE WHEN {d} IS NOT NULL THEN greatest(0, least(100, 100 - greatest({d}, 0))) END"


def nz(x: str, default: str) -> str:
    """fillna: NULL (and NaN for doubles) -> default."""
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN {default} ELSE {x} END"


SILVER = f"""
bronze AS (SELECT * FROM raw),
dated AS (
  SELECT * EXCLUDE (ReadingDate, source, batch_id, ingested_at), try_cast(ReadingDate AS DATE) AS ReadingDate,
         CAST(strftime(try_cast(ReadingDate AS DATE), '%Y%m%d') AS INTEGER) AS date_key
  FROM bronze
),
picked AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY RecordID ORDER BY RoomArea NULLS FIRST, NumberofAppliances NULLS FIRST,
           OutsideTemperature NULLS FIRST, InsulationThickness NULLS FIRST, BuildingType NULLS FIRST, HVACSystem NULLS FIRST,
           AverageTemperature NULLS FIRST, EnergyConsumption NULLS FIRST, ReadingDate NULLS FIRST, date_key NULLS FIRST) AS rn
    FROM dated) WHERE rn = 1
),
silver AS (
  SELECT RecordID, CAST(coalesce(RoomArea, 0) AS INTEGER) AS RoomArea,
         CAST(coalesce(NumberofAppliances, 0) AS INTEGER) AS NumberofAppliances,
         {nz('OutsideTemperature', '0.0')} AS OutsideTemperature, {nz('InsulationThickness', '0.0')} AS InsulationThickness,
         coalesce(BuildingType, 'Unknown') AS BuildingType, coalesce(HVACSystem, 'Unknown') AS HVACSystem,
         {nz('AverageTemperature', '0.0')} AS AverageTemperature, {nz('EnergyConsumption', '0.0')} AS EnergyConsumption,
         ReadingDate, date_key
  FROM picked
),
fact AS (
  SELECT RecordID, md5(BuildingType) AS building_type_key, md5(HVACSystem) AS hvac_key, date_key, RoomArea,
         NumberofAppliances, OutsideTemperature, InsulationThickness, AverageTemperature, EnergyConsumption
  FROM silver
)"""

SILVER_CHAIN = ",".join([RAW, SILVER])


def with_silver(select: str, ctes: str | None = None) -> str:
    """The silver chain, optionally followed by more CTEs, then the select."""
    more = f",\n{ctes}" if ctes else ""
    return f"WITH {SILVER_CHAIN}{more}\n{select}"


DATE_PARTS = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
       CAST(quarter(d) AS INTEGER) AS quarter, dayofweek(d) IN (0, 6) AS is_weekend"""


def calendar_sql(source: str) -> str:
    return f"""SELECT {DATE_PARTS}
FROM (SELECT CAST(unnest(generate_series(min(ReadingDate), max(ReadingDate), INTERVAL 1 DAY)) AS DATE) AS d FROM {source})"""
