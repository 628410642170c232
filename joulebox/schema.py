"""Explicit schemas for every layer (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import types as T

# The column-name groups of the data contract, in its order.
NUMERIC_COLUMNS = [
    "RoomArea",
    "NumberofAppliances",
    "OutsideTemperature",
    "InsulationThickness",
    "AverageTemperature",
    "EnergyConsumption",
]
CATEGORY_COLUMNS = ["BuildingType", "HVACSystem"]
REQUIRED_COLUMNS = [
    "RoomArea",
    "NumberofAppliances",
    "OutsideTemperature",
    "InsulationThickness",
    "BuildingType",
    "HVACSystem",
    "AverageTemperature",
    "EnergyConsumption",
]
OUTLIER_COLUMNS = ["RoomArea", "NumberofAppliances", "EnergyConsumption"]
ML_REQUIRED_COLUMNS = [
    "AverageTemperature",
    "OutsideTemperature",
    "InsulationThickness",
    "NumberofAppliances",
    "RoomArea",
    "TemperatureDifference",
    "BuildingType",
    "HVACSystem",
    "EnergyConsumption",
    "EnergyPerArea",
]
ML_NUMERIC_COLUMNS = [
    "AverageTemperature",
    "OutsideTemperature",
    "InsulationThickness",
    "NumberofAppliances",
    "RoomArea",
    "TemperatureDifference",
    "EnergyConsumption",
    "EnergyPerArea",
]
INGEST_METADATA = ["source", "batch_id", "ingested_at"]

# F1, loose raw reading (pipeline A). Types are what JSON inference yields for
# well-formed input; a reader may still pass strings, which the cleaner casts.
RAW_READING_LOOSE = T.StructType(
    [
        T.StructField("AverageTemperature", T.DoubleType()),
        T.StructField("BuildingType", T.StringType()),
        T.StructField("EnergyConsumption", T.DoubleType()),
        T.StructField("HVACSystem", T.StringType()),
        T.StructField("InsulationThickness", T.DoubleType()),
        T.StructField("NumberofAppliances", T.DoubleType()),
        T.StructField("Outside Temperature", T.DoubleType()),
        T.StructField("RoomArea", T.DoubleType()),
    ]
)

# F2, strict raw reading (pipeline B bronze).
RAW_READING = T.StructType(
    [
        T.StructField("RecordID", T.StringType()),
        T.StructField("RoomArea", T.IntegerType()),
        T.StructField("NumberofAppliances", T.IntegerType()),
        T.StructField("OutsideTemperature", T.DoubleType()),
        T.StructField("InsulationThickness", T.DoubleType()),
        T.StructField("BuildingType", T.StringType()),
        T.StructField("HVACSystem", T.StringType()),
        T.StructField("AverageTemperature", T.DoubleType()),
        T.StructField("EnergyConsumption", T.DoubleType()),
        T.StructField("ReadingDate", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("ingested_at", T.StringType()),
        T.StructField("batch_id", T.StringType()),
    ]
)

# Columns of the fact, prediction and health tables.
FACT_COLUMNS = [
    "RecordID",
    "building_type_key",
    "hvac_key",
    "date_key",
    "RoomArea",
    "NumberofAppliances",
    "OutsideTemperature",
    "InsulationThickness",
    "AverageTemperature",
    "EnergyConsumption",
]

PREDICTION_COLUMNS = [
    "EnergyConsumption",
    "prediction",
    "BuildingType",
    "HVACSystem",
    "RoomArea",
    "NumberofAppliances",
    "InsulationThickness",
    "EnergyPerArea",
]

HEALTH_COLUMNS = [
    "BuildingType",
    "HVACSystem",
    "RoomArea",
    "NumberofAppliances",
    "InsulationThickness",
    "EnergyPerArea",
    "ActualEnergy",
    "ExpectedEnergy",
    "DeviationPercent",
    "EfficiencyStatus",
]

# Efficiency status labels written by the health step and read by the reports.
STATUS_ABOVE = "Inefficient (Above Expected)"
STATUS_BELOW = "Highly Efficient (Below Expected)"
STATUS_NORMAL = "Normal Range"
