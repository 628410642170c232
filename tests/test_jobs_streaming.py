import os

import pytest
from pyspark.sql import functions as F

from joulebox.operators.indexing import global_index
from joulebox.plans import jobs
from joulebox.schema import RAW_READING
from joulebox.sources import testdata
from joulebox.sources.topic import advance, publish, topic_stream
from joulebox.streaming.batches import stamp_batches
from joulebox.streaming.ingest import collect_topic, ingest_files, write_epochs


def test_first_pipeline_end_to_end(spark, sf_small, tmp_path):
    raw = str(tmp_path / "raw")
    testdata.loose_readings(spark, sf_small).write.json(raw)
    out = str(tmp_path / "out")
    rep = jobs.etl_job(spark, raw, out, iqr_mode="approx")
    assert rep["raw_records"] == testdata.loose_readings(spark, sf_small).count()
    assert rep["clean_records"] == spark.read.json(f"{out}/processed/energy").count() > 0
    metrics = jobs.model_job(spark, f"{out}/processed/energy", out)
    assert metrics["rmse"] > 0 and metrics["total"] > 0 and 0 < metrics["flagged"] < metrics["total"]
    tables = jobs.publish_job(spark, out, prefix="t1_")
    assert len(tables) == 6 and spark.table("t1_building_health").count() == metrics["total"]
    for name in jobs.REPORTS:  # the dashboard reads the published tables
        assert jobs.report(spark, name, "t1_").count() > 0, name
    everything, some = (jobs.report(spark, "kpis", "t1_", *f).first() for f in ((), ("Promo", "VRF")))
    assert 0 < some["total_energy"] < everything["total_energy"] and some["building_types"] == 1
    tops = [r["totalEnergy"] for r in jobs.report(spark, "top_types", "t1_").collect()]
    assert tops == sorted(tops, reverse=True)
    with pytest.raises(ValueError, match="no report"):
        jobs.report(spark, "nothing")
    from joulebox.plans.model import load_model

    assert load_model(f"{out}/models/energy_linear_regression").stages[-1].getRegParam() == 0.1


def test_medallion_end_to_end_idempotent(spark, sf_small, tmp_path):
    landing = str(tmp_path / "landing")
    stamped = stamp_batches(testdata.loose_readings(spark, sf_small).withColumnRenamed("Outside Temperature", "OutsideTemperature")
                            .withColumn("ReadingDate", F.lit("2024-05-17")), ["RoomArea", "EnergyConsumption"], 500,
                            ingested_at="2024-05-17 00:00:00")
    stamped.withColumn("batch", F.col("batch_id")).write.partitionBy("batch").json(landing)
    bronze, lake, ledger = str(tmp_path / "bronze"), str(tmp_path / "lake"), str(tmp_path / "ledger")
    batches = sorted(d for d in os.listdir(landing) if d.startswith("batch="))
    assert len(batches) == (stamped.count() + 499) // 500
    for b in batches:
        assert jobs.extract_job(spark, f"{landing}/{b}", bronze)["written"]
    first = jobs.transform_job(spark, bronze, lake, ledger)
    assert jobs.load_job(spark, lake, prefix="t2_")["fact"] == "created"
    jobs.extract_job(spark, f"{landing}/{batches[0]}", bronze)  # extracting a batch again adds nothing
    again = jobs.transform_job(spark, bronze, lake, ledger)  # nothing new: ledger holds every batch
    assert first["silver_rows"] > 0 and again["silver_rows"] == 0
    assert spark.read.parquet(f"{lake}/silver/power_consumption").count() == first["silver_rows"]
    assert jobs.load_job(spark, lake, prefix="t2_")["fact"] == "skipped"  # empty staging leaves the table alone
    assert spark.table("t2_fact_energy_consumption").count() == first["silver_rows"]


def test_transform_done_over_after_a_crash(spark, sf_small, tmp_path, monkeypatch):
    bronze, lake, ledger = str(tmp_path / "bronze"), str(tmp_path / "lake"), str(tmp_path / "ledger")
    raw = testdata.raw_readings(spark, sf_small).withColumn("batch_id", F.when(F.col("batch_id") != F.lit("x"), F.col("batch_id")))
    raw = raw.withColumn("batch_id", F.when(F.col("RoomArea") != 7, F.col("batch_id")))  # some rows have no batch id
    raw.write.parquet(bronze)
    finish = jobs.ledgers.finish
    monkeypatch.setattr(jobs.ledgers, "finish", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        jobs.transform_job(spark, bronze, lake, ledger)
    monkeypatch.setattr(jobs.ledgers, "finish", finish)
    rows = raw.select("RecordID").distinct().count()
    assert jobs.transform_job(spark, bronze, lake, ledger)["silver_rows"] == rows  # the same run again
    assert spark.read.parquet(f"{lake}/silver/power_consumption").count() == rows
    assert jobs.transform_job(spark, bronze, lake, ledger)["silver_rows"] == 0  # rows without a batch id neither


def _batch(spark, folder, rows):
    frame = spark.createDataFrame(rows, "RecordID string, EnergyConsumption double, batch_id string")
    frame.withColumn("ReadingDate", F.lit("2024-05-17")).coalesce(1).write.mode("append").json(folder)


def test_late_files_empty_runs_and_loads_lose_no_fact(spark, tmp_path):
    landing, bronze, lake, ledger = (str(tmp_path / n) for n in ("landing", "bronze", "lake", "ledger"))
    stored = lambda: dict(map(tuple, spark.table("t5_fact_energy_consumption").select("RecordID", "EnergyConsumption").collect()))
    step = lambda: (jobs.extract_job(spark, landing, bronze)["written"], jobs.transform_job(spark, bronze, lake, ledger)["silver_rows"])
    _batch(spark, landing, [("r1", 1.0, "B1"), ("r2", 2.0, "B1")])
    assert step() == (True, 2)
    assert step() == (False, 0)  # an empty run leaves the fact rows that wait for a load
    assert spark.read.parquet(f"{lake}/gold/fact_energy_consumption").count() == 2
    _batch(spark, landing, [("r3", 3.0, "B1"), ("r1", 9.0, "B1")])  # late rows of a batch that was taken
    assert step() == (True, 2)
    assert jobs.load_job(spark, lake, prefix="t5_") == {"fact": "created", "runs": 2}  # two runs before a load
    assert stored() == {"r1": 9.0, "r2": 2.0, "r3": 3.0}
    assert jobs.load_job(spark, lake, prefix="t5_") == {"fact": "skipped", "runs": 0}
    _batch(spark, landing, [("r4", 4.0, None)])
    assert step() == (True, 1) and jobs.load_job(spark, lake, prefix="t5_") == {"fact": "merged", "runs": 1}
    assert stored() == {"r1": 9.0, "r2": 2.0, "r3": 3.0, "r4": 4.0}


def test_extract_done_over_after_a_crash(spark, tmp_path, monkeypatch):
    landing, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    _batch(spark, landing, [("r1", 1.0, "B1")])
    finish = jobs.ledgers.finish
    monkeypatch.setattr(jobs.ledgers, "finish", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        jobs.extract_job(spark, landing, bronze)
    monkeypatch.setattr(jobs.ledgers, "finish", finish)
    _batch(spark, landing, [("r2", 2.0, "B1")])
    assert jobs.extract_job(spark, landing, bronze)["written"] and jobs.extract_job(spark, landing, bronze)["written"]
    assert sorted(r.RecordID for r in spark.read.parquet(bronze).collect()) == ["r1", "r2"]


def test_jobs_leave_no_staged_copies(spark, sf_small, tmp_path):
    from joulebox.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    testdata.loose_readings(spark, sf_small).limit(500).write.json(raw)
    jobs.etl_job(spark, raw, out, declared=True)
    jobs.extract_job(spark, raw, f"{out}/bronze", f"{out}/bad")
    assert set(os.listdir(folder)) == before


def test_stream_ingest_restart_adds_nothing(spark, tmp_path):
    landing = str(tmp_path / "landing")
    rows = spark.createDataFrame([(f"REC-{i:06d}", i, f"POWER-BATCH-{i // 10 + 1:04d}") for i in range(40)],
                                 "RecordID string, RoomArea int, batch_id string")
    rows.repartition(4).write.json(landing)
    target, ckpt = str(tmp_path / "raw"), str(tmp_path / "ckpt")
    ingest_files(spark, landing, RAW_READING, target, ckpt)
    assert spark.read.parquet(target).count() == 40
    ingest_files(spark, landing, RAW_READING, target, ckpt)  # restart, same checkpoint
    assert spark.read.parquet(target).count() == 40
    rows.limit(5).write.mode("append").json(landing)  # a new file arrives
    ingest_files(spark, landing, RAW_READING, target, ckpt)
    assert spark.read.parquet(target).count() == 45


READING = "RecordID string, RoomArea int"


def _topic(spark, path, lo, hi):
    publish(spark.range(lo, hi).select(F.format_string("REC-%06d", "id").alias("RecordID"), F.col("id").cast("int").alias("RoomArea")), path, ["RoomArea"])


def _collected(spark, target):
    rows = spark.read.parquet(target)
    per_epoch = [r["count"] for r in rows.groupBy("epoch").count().collect()]
    return sorted(r.RoomArea for r in rows.collect()), max(per_epoch)


def test_collector_bounds_stops_and_resumes(spark, tmp_path):
    path, target, ckpt = (str(tmp_path / n) for n in ("topic", "raw", "ckpt"))
    schema = spark.createDataFrame([], READING).schema
    _topic(spark, path, 0, 250)
    collect_topic(spark, path, schema, target, ckpt, max_rows=40, stop_after=100)
    assert _collected(spark, target)[0] == list(range(100)) or len(_collected(spark, target)[0]) == 100
    collect_topic(spark, path, schema, target, ckpt, max_rows=40, stop_after=100)
    assert len(_collected(spark, target)[0]) == 200
    collect_topic(spark, path, schema, target, ckpt, max_rows=40)
    assert _collected(spark, target) == (list(range(250)), 40)
    collect_topic(spark, path, schema, target, ckpt, max_rows=40)  # nothing new
    _topic(spark, path, 250, 270)  # the topic goes on
    collect_topic(spark, path, schema, target, ckpt, max_rows=40)
    assert _collected(spark, target) == (list(range(270)), 40)


def test_collector_killed_between_write_and_commit(spark, tmp_path):
    path, target, ckpt = (str(tmp_path / n) for n in ("topic", "raw", "ckpt"))
    schema = spark.createDataFrame([], READING).schema
    _topic(spark, path, 0, 120)

    def die(epoch):
        if epoch == 1:
            raise RuntimeError("killed before the commit")

    with pytest.raises(Exception, match="killed before the commit"):
        collect_topic(spark, path, schema, target, ckpt, max_rows=50, after_write=die)
    written = _collected(spark, target)[0]
    assert len(written) == 100 and sorted(os.listdir(f"{ckpt}/commits"))[-1] == "0"  # epoch 1 is written, not committed
    _topic(spark, path, 120, 130)
    collect_topic(spark, path, schema, target, ckpt, max_rows=50)
    assert _collected(spark, target) == (list(range(130)), 50)


def test_topic_offsets_are_dealt_evenly():
    assert advance({"0": 0, "1": 0, "2": 0}, {"0": 50, "1": 50, "2": 50}, 100) == {"0": 34, "1": 33, "2": 33}
    assert advance({"0": 0, "1": 0}, {"0": 3, "1": 500}, 100) == {"0": 3, "1": 97}
    assert advance({"0": 5}, {"0": 5, "1": 7}, None) == {"0": 5, "1": 7}
    assert advance({"0": 5}, {"0": 5}, 10) == {"0": 5}


def test_topic_records_have_the_shape_of_kafka_ones(spark, tmp_path):
    path = str(tmp_path / "topic")
    publish(spark.createDataFrame([("a", None), ("b", 2)], READING), path, ["RecordID"], key=F.col("RecordID"), partitions=3)
    stream = topic_stream(spark, path, "meters")
    assert stream.schema.simpleString() == "struct<key:binary,value:binary,topic:string,partition:int,offset:bigint,timestamp:timestamp>"
    query = write_epochs(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    query.processAllAvailable()
    query.stop()
    rows = sorted((r.partition, r.offset, bytes(r.key), bytes(r.value), r.topic) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert rows == [(0, 0, b"a", b'{"RecordID":"a","RoomArea":null}', "meters"), (1, 0, b"b", b'{"RecordID":"b","RoomArea":2}', "meters")]
    with pytest.raises(Exception, match="need the option checkpoint"):
        topic_stream(spark, path, max_rows=5).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c2")).start().processAllAvailable()


def test_stream_keeps_lines_that_are_not_json(spark, tmp_path):
    from joulebox.sources.files import split_corrupt

    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text('{"RecordID": "REC-000001", "RoomArea": 5}\nnot json\n')
    ingest_files(spark, str(landing), RAW_READING, str(tmp_path / "raw"), str(tmp_path / "ckpt"), keep_corrupt=True)
    good, bad = split_corrupt(spark.read.parquet(str(tmp_path / "raw")))
    assert [r["RecordID"] for r in good.collect()] == ["REC-000001"] and [r[0] for r in bad.collect()] == ["not json"]


def test_global_index_contiguous_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit(1).alias("dup")).repartition(7)
    df = df.unionByName(df.limit(0))
    idx = global_index(df, ["k"], "i", partitions=5).collect()
    pairs = sorted((r["i"], r["k"]) for r in idx)
    assert [p[0] for p in pairs] == list(range(1000)) and [p[1] for p in pairs] == sorted(p[1] for p in pairs)


def test_global_index_with_a_hot_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id")).alias("k"))
    idx = global_index(df, ["k"], "i", partitions=6)
    assert sorted(r["i"] for r in idx.collect()) == list(range(3000))
    assert idx.filter(F.col("k") == 0).agg(F.max("i")).first()[0] == 999


def test_stamp_batches_format(spark):
    df = spark.createDataFrame([(i,) for i in range(120)], "v int").repartition(3)
    out = {r["v"]: r for r in stamp_batches(df, ["v"], 50, ingested_at="2024-01-01 00:00:00").collect()}
    assert out[0]["RecordID"] == "REC-000000" and out[49]["batch_id"] == "POWER-BATCH-0001"
    assert out[50]["batch_id"] == "POWER-BATCH-0002" and out[119]["RecordID"] == "REC-000119"
    assert {r["source"] for r in out.values()} == {"power_consumption_sensor"}


def test_parquet_layers_and_partitioned_lake(spark, sf_small, tmp_path):
    raw = str(tmp_path / "raw")
    testdata.loose_readings(spark, sf_small).write.json(raw)
    out = str(tmp_path / "out")
    rep = jobs.etl_job(spark, raw, out, fmt="parquet")
    assert spark.read.parquet(f"{out}/processed/energy").count() == rep["clean_records"]
    m = jobs.model_job(spark, f"{out}/processed/energy", out, fmt="parquet")
    assert m["total"] == spark.read.parquet(f"{out}/analytics/building_health").count()
    bronze = str(tmp_path / "bronze")
    testdata.raw_readings(spark, sf_small).write.parquet(bronze)
    lake = str(tmp_path / "lake")
    jobs.transform_job(spark, bronze, lake, partition_by=["date_key"])
    fact = spark.read.parquet(f"{lake}/gold/fact_energy_consumption")
    one_day = fact.filter(F.col("date_key") == 19960101)
    assert "PartitionFilters: [isnotnull(date_key" in one_day._jdf.queryExecution().executedPlan().toString()
