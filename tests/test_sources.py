import json
import os

import pytest

from joulebox.plans import readings as R
from joulebox.sources import files
from joulebox.sources.kafka import decode_values
from joulebox.schema import RAW_READING


def test_json_array_files_and_lines(spark, tmp_path):
    arr = tmp_path / "raw" / "batch_001.json"
    arr.parent.mkdir()
    rows = [{"RoomArea": 120, "NumberofAppliances": 4.0, "Outside Temperature": 12.5, "InsulationThickness": 3,
             "BuildingType": " office", "HVACSystem": "split ac", "AverageTemperature": 22.0, "EnergyConsumption": 900.5},
            {"RoomArea": 80, "NumberofAppliances": 2.0, "Outside Temperature": float("nan"), "InsulationThickness": 1,
             "BuildingType": "NaN", "HVACSystem": "no hvac", "AverageTemperature": 20.0, "EnergyConsumption": 400.0}]
    arr.write_text(json.dumps(rows))  # one JSON array on one line, NaN token included
    (tmp_path / "raw" / "batch_002.json").write_text(json.dumps(rows[0]) + "\n")  # JSON lines
    df = files.read_json_inferred(spark, str(tmp_path / "raw"))
    assert df.count() == 3 and "Outside Temperature" in df.columns
    clean = R.clean_readings(df, stage=False)
    got = sorted((r["BuildingType"], r["HVACSystem"]) for r in clean.collect())
    assert got == [("Office", "Split AC")]  # duplicate removed, NaN temperature dropped


def test_csv_header_trim(spark, tmp_path):
    p = tmp_path / "data.csv"
    p.write_text(" RoomArea , Outside Temperature ,BuildingType\n120,12.5,office\n80,,home\n")
    df = files.read_csv_trimmed(spark, str(p))
    assert df.columns == ["RoomArea", "Outside Temperature", "BuildingType"]
    assert [r["Outside Temperature"] for r in df.collect()] == ["12.5", None]


def test_parameterised_sql(spark):
    df = spark.createDataFrame([("VRF", 1), ("VRF", 2), ("No HVAC", 3)], "HVACSystem string, x int")
    got = files.run_table_query(spark, "SELECT sum(x) AS s FROM r WHERE HVACSystem = :h", views={"r": df}, h="VRF")
    assert got.first()["s"] == 3
    evil = files.run_table_query(spark, "SELECT count(*) AS n FROM r WHERE HVACSystem = :h", views={"r": df}, h="x' OR '1'='1")
    assert evil.first()["n"] == 0  # bound, not concatenated


def test_kafka_value_decode(spark):
    msgs = spark.createDataFrame([(bytearray(json.dumps({"RecordID": "REC-000001", "RoomArea": 10}).encode()),), (bytearray(b"{bad"),)],
                                 "value binary")
    rows = decode_values(msgs, RAW_READING).collect()
    assert rows[0]["RecordID"] == "REC-000001" and rows[0]["RoomArea"] == 10
    assert rows[1]["RecordID"] is None


def test_counts_are_pushed_into_the_reader(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id % 3 as p").write.partitionBy("p").parquet(path)
    counted = files.pushed_counts(spark, path)
    assert counted.first()[0] == 1000 and "PushedAggregation: [COUNT(*)]" in counted._jdf.queryExecution().executedPlan().toString()
    by = files.pushed_counts(spark, path, ["p"])
    assert {(r.p, r.cnt) for r in by.collect()} == {(0, 334), (1, 333), (2, 333)}
    plan = by._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [p]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was


def test_published_tables_are_replaced_wholly_or_not_at_all(spark, tmp_path):
    from pyspark.sql import functions as F

    from joulebox.sources import warehouse

    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        warehouse.read_published(spark, path)
    warehouse.publish(spark.range(100).selectExpr("id", "cast(id as string) as s", "cast(null as double) as d").repartition(4), path)
    old = warehouse.read_published(spark, path)
    assert old.count() == 100 and old.schema.simpleString() == "struct<id:bigint,s:string,d:double>"
    broken = spark.range(100).repartition(4).select("id", F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise("x").alias("s"), F.lit(1.0).alias("d"))
    with pytest.raises(Exception, match="broken"):
        warehouse.publish(broken, path)
    assert warehouse.read_published(spark, path).count() == 100 and len([f for f in os.listdir(path) if "-" in f]) == 1  # the failed version is gone
    warehouse.publish(spark.range(7).selectExpr("id", "'y' as s", "0.5 as d"), path)
    assert warehouse.read_published(spark, path).count() == 7 and old.count() == 100  # planned before: it reads its version
    assert warehouse.remove_old_versions(path, 3600) == [] and len(warehouse.remove_old_versions(path, 0)) == 1
    warehouse.publish(spark.range(0).selectExpr("id", "'y' as s", "0.5D as d"), path)
    assert warehouse.read_published(spark, path).count() == 0


def test_json_types_found_while_lines_are_stored(spark, tmp_path):
    lines = [
        '{"a":1,"b":1.50,"c":"x","d":24710.0,"n":null,"o":{"p":1},"l":[1,2],"big":12345678901234567890123,"e":1.0E10,"w":5.0}',
        '{"a":2.5,"b":2,"c":5,"d":"NaN","t":true,"o":{"q":"z"},"l":["s"],"e":3,"w":7.0, "i": 9}',
        "", '[{"a":7},{"a":8,"c":"é, \\"q\\""}]', '{"a": NaN}',
    ]
    for name, own in (("good", lines), ("bad", [*lines, "not json", '{"a": 5'])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.json").write_text("\n".join(own))
        path = str(tmp_path / name)
        want, got = files.read_json_inferred(spark, path), files.read_json_stored(spark, path)
        assert got.schema == want.schema
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.json").write_text("")
    assert files.read_json_stored(spark, str(tmp_path / "none")).count() == 0
