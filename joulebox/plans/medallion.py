"""The medallion pipeline: raw JSON -> bronze -> silver -> gold star schema.

* bronze: fixed-schema JSON read, corrupt lines split off, appended.
* silver: parsed date + yyyyMMdd key, ingest metadata dropped, one row per
  RecordID (deterministic pick), NULLs filled, types fixed.
* gold: calendar dimension, md5-keyed category dimensions, fact table.

The fact's surrogate keys are ``md5(value)``, the same function the dimensions
use, so the fact computes them per row instead of joining the dimensions back
(no shuffle, no broadcast of a dimension whose size grows with the data);
``fact_energy_via_dims`` keeps the lookup-join form for persisted dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joulebox.functions.dates import date_key, date_parts, parse_date
from joulebox.operators.cleaning import fill_missing
from joulebox.operators.dedup import dedup_key
from joulebox.operators.joins import lookup_keys
from joulebox.schema import FACT_COLUMNS, INGEST_METADATA, RAW_READING
from joulebox.sources.files import CORRUPT_COLUMN, read_json_schema, split_corrupt

# What silver puts in place of missing values, and its types.
NUMERIC_DEFAULTS = {
    "RoomArea": 0,
    "NumberofAppliances": 0,
    "OutsideTemperature": 0.0,
    "InsulationThickness": 0.0,
    "AverageTemperature": 0.0,
    "EnergyConsumption": 0.0,
}
CATEGORY_DEFAULTS = {"BuildingType": "Unknown", "HVACSystem": "Unknown"}
SILVER_TYPES = {
    "RoomArea": "int",
    "NumberofAppliances": "int",
    "OutsideTemperature": "double",
    "InsulationThickness": "double",
    "AverageTemperature": "double",
    "EnergyConsumption": "double",
}


#: How raw JSON lines are read: not-a-number values are allowed, unparsable lines keep their text.
RAW_OPTIONS = {"allowNonNumericNumbers": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def raw_schema() -> T.StructType:
    return T.StructType([*RAW_READING.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])


def read_raw_batch(spark: SparkSession, path: str, quarantine: bool = True) -> tuple[DataFrame, DataFrame]:
    """Fixed-schema read of raw JSON lines: (valid rows, corrupt raw lines).

    Values of the wrong type become NULL; lines that are not JSON land in the
    second frame instead of becoming all-NULL rows.
    """
    df = read_json_schema(spark, path, RAW_READING, keep_corrupt=quarantine)
    return split_corrupt(df)


def to_silver(bronze: DataFrame) -> DataFrame:
    df = bronze.withColumn("ReadingDate", parse_date("ReadingDate"))
    df = df.withColumn("date_key", date_key("ReadingDate"))
    df = df.drop(*INGEST_METADATA)
    df = dedup_key(df, "RecordID")
    df = fill_missing(df, NUMERIC_DEFAULTS, CATEGORY_DEFAULTS)
    return df.withColumns({c: F.col(c).cast(t) for c, t in SILVER_TYPES.items()})


def calendar(spark: SparkSession, start: str = "2019-01-01", end: str = "2030-12-31") -> DataFrame:
    """Static calendar dimension for [start, end] (4,383 rows by default)."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("interval 1 day"))).alias("date")
    )
    return days.select(*date_parts("date"))


def calendar_for(df: DataFrame, date_col: str) -> DataFrame:
    """Calendar spanning the dates present in ``df`` (one aggregate row exploded)."""
    span = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    days = span.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.col("lo"), F.col("hi"), F.expr("interval 1 day"))).alias("date")
    )
    return days.select(*date_parts("date"))


def dim_building_type(silver: DataFrame) -> DataFrame:
    return silver.select("BuildingType").distinct().select(F.md5("BuildingType").alias("building_type_key"), "BuildingType")


def dim_hvac_system(silver: DataFrame) -> DataFrame:
    return silver.select("HVACSystem").distinct().select(F.md5("HVACSystem").alias("hvac_key"), "HVACSystem")


def fact_energy(silver: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Fact rows with md5 surrogate keys, one per RecordID (silver is already unique).

    ``extra`` silver columns (e.g. the reading date for partitioning) are kept at the end.
    """
    return silver.select(
        "RecordID",
        F.md5("BuildingType").alias("building_type_key"),
        F.md5("HVACSystem").alias("hvac_key"),
        *FACT_COLUMNS[3:],
        *(extra or []),
    )


def fact_energy_via_dims(silver: DataFrame, dim_building: DataFrame, dim_hvac: DataFrame) -> DataFrame:
    """Fact rows with keys looked up from (persisted) dimensions by natural value."""
    j = lookup_keys(silver, dim_building, "BuildingType")
    j = lookup_keys(j, dim_hvac, "HVACSystem")
    return j.select(*FACT_COLUMNS)
