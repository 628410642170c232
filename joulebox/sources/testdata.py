"""Adapter from the driver's TPC-H-like tables to the reading shapes.

The reference ships no data, so readings are derived from ``lineitem`` joined
written once more as DuckDB SQL in ``joulebox.registry`` for the oracles.
The join is left to the planner: ``part`` is broadcast while its file
statistics are under the broadcast threshold and sort-merge joined beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineitem_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    return li.join(part, li.l_partkey == part.p_partkey, "inner")


def _mapped_columns() -> dict[str, F.Column]:
    ln = F.col("l_linenumber")
    qty = F.col("l_quantity")
    return {
        "building": F.when(ln == 7, F.lit("NaN"))
        .when(ln == 6, F.lit(""))
        .otherwise(F.concat(F.lit(" "), F.lower("p_type"))),
        "hvac": F.when(F.col("l_returnflag") == "A", F.lit("central ac"))
        .when(F.col("l_returnflag") == "N", F.lit("no hvac"))
        .otherwise(F.lit("vrf")),
        "energy": F.when((ln == 5) & (qty < 5), F.lit(float("nan")))
        .when((ln == 4) & (qty < 3), F.lit(-1.0))
        .otherwise(F.col("l_extendedprice")),
        "outside": F.col("l_tax") * 1500 - 55,
        "insulation": F.col("l_discount") * 100,
        "average": F.col("p_retailprice") - 925,
    }


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict raw readings (F2 shape, bronze input) including ingest metadata."""
    m = _mapped_columns()
    ship = F.col("l_shipdate")
    batch_no = (F.year(ship) - 1992) * 12 + F.month(ship)
    return _lineitem_part(spark, sf_dir).select(
        F.concat(F.lit("REC-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias(
            "RecordID"
        ),
        F.col("p_size").cast("int").alias("RoomArea"),
        F.col("l_quantity").cast("int").alias("NumberofAppliances"),
        m["outside"].alias("OutsideTemperature"),
        m["insulation"].alias("InsulationThickness"),
        m["building"].alias("BuildingType"),
        m["hvac"].alias("HVACSystem"),
        m["average"].alias("AverageTemperature"),
        m["energy"].alias("EnergyConsumption"),
        F.date_format(ship, "yyyy-MM-dd").alias("ReadingDate"),
        F.lit("power_consumption_sensor").alias("source"),
        F.date_format(ship, "yyyy-MM-dd 00:00:00").alias("ingested_at"),
        F.format_string("POWER-BATCH-%04d", batch_no).alias("batch_id"),
    )


def loose_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loose raw readings (F1 shape, pipeline A input): spaced column name, double appliances."""
    m = _mapped_columns()
    return _lineitem_part(spark, sf_dir).select(
        F.col("p_size").alias("RoomArea"),
        F.col("l_quantity").alias("NumberofAppliances"),
        m["outside"].alias("Outside Temperature"),
        m["insulation"].alias("InsulationThickness"),
        m["building"].alias("BuildingType"),
        m["hvac"].alias("HVACSystem"),
        m["average"].alias("AverageTemperature"),
        m["energy"].alias("EnergyConsumption"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
