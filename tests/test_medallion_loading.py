import pytest
import uuid
import json
import os

from pyspark.sql import functions as F

from joulebox.plans import ledger as ledgers
from joulebox.plans import loading as L
from joulebox.plans import medallion as G


def write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def rec(i, **kw):
    r = {"RecordID": f"REC-{i:06d}", "RoomArea": 100 + i, "NumberofAppliances": 3, "OutsideTemperature": 10.5,
         "InsulationThickness": 2.0, "BuildingType": "Office", "HVACSystem": "VRF", "AverageTemperature": 21.0,
         "EnergyConsumption": 500.0 + i, "ReadingDate": "2024-05-17", "source": "power_consumption_sensor",
         "ingested_at": "2024-05-17 10:00:00", "batch_id": "POWER-BATCH-0001"}
    r.update(kw)
    return json.dumps(r)


def test_raw_batch_quarantine_and_types(spark, tmp_path):
    path = str(tmp_path / "raw" / "power_batch_0001.json")
    write_lines(path, [rec(1), rec(2, RoomArea="abc"), "this is not json", rec(3, ReadingDate="2024-13-40"),
                       json.dumps({"RecordID": None})])
    good, bad = G.read_raw_batch(spark, path)
    assert bad.count() == 1 and "not json" in bad.first()[0]
    rows = {r["RecordID"]: r for r in good.collect()}
    assert rows["REC-000002"]["RoomArea"] is None  # wrong type -> NULL, row kept
    silver = {r["RecordID"]: r for r in G.to_silver(good).collect()}
    assert silver["REC-000003"]["ReadingDate"] is None and silver["REC-000003"]["date_key"] is None
    assert silver["REC-000002"]["RoomArea"] == 0 and silver[None]["BuildingType"] == "Unknown"


def test_empty_batch_skips_write(spark, tmp_path):
    path = str(tmp_path / "empty.json")
    write_lines(path, [""])
    good, _ = G.read_raw_batch(spark, path)
    assert L.append_if_rows(good, str(tmp_path / "bronze")) is False
    assert not L.path_exists(spark, str(tmp_path / "bronze"))


def test_silver_dedup_fill_and_star(spark, tmp_path):
    path = str(tmp_path / "raw.json")
    write_lines(path, [rec(1), rec(1, EnergyConsumption=1.0), rec(2, BuildingType=None), rec(3, HVACSystem="Split AC")])
    good, _ = G.read_raw_batch(spark, path)
    silver = G.to_silver(good)
    got = {r["RecordID"]: r for r in silver.collect()}
    assert len(got) == 3 and got["REC-000001"]["EnergyConsumption"] == 1.0  # smallest row kept
    assert got["REC-000001"]["date_key"] == 20240517
    fact = G.fact_energy(silver)
    via = G.fact_energy_via_dims(silver, G.dim_building_type(silver), G.dim_hvac_system(silver))
    assert sorted(map(tuple, fact.collect())) == sorted(map(tuple, via.collect()))
    assert G.calendar(spark).count() == 4383


def test_merge_upsert_properties(spark):
    schema = "RecordID string, v int"
    target = spark.createDataFrame([("a", 1), ("b", 1), (None, 1), ("c", 1)], schema)
    source = spark.createDataFrame([("b", 2), ("d", 2), (None, 2)], schema)
    merged = sorted(map(tuple, L.merge_upsert(target, source, "RecordID").collect()), key=str)
    assert merged == sorted([("a", 1), ("b", 2), ("c", 1), ("d", 2), (None, 1), (None, 2)], key=str)
    counts = L.merge_counts(target, source, "RecordID").first()
    assert (counts["updated"], counts["inserted"]) == (1, 2)


def test_merge_into_table_and_swap(spark):
    schema = "RecordID string, v int"
    t = "merge_test_fact"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    assert L.merge_into_table(spark, spark.createDataFrame([("a", 1), ("b", 1)], schema), t, "RecordID") == "created"
    src = spark.createDataFrame([("b", 2), ("c", 2)], schema)
    assert L.merge_into_table(spark, src, t, "RecordID") == "merged"
    assert L.merge_into_table(spark, src, t, "RecordID") == "merged"  # re-running the same batch changes nothing
    assert sorted(map(tuple, spark.table(t).collect())) == [("a", 1), ("b", 2), ("c", 2)]


def test_dim_append_new_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "dim")
    dim = spark.createDataFrame([("k1", "A"), ("k2", "B"), ("k2", "B")], "key string, name string")
    first = L.dim_append_new(spark, dim, path, "key")
    assert first.count() == 2
    batch = spark.createDataFrame([("k2", "changed"), ("k3", "C")], "key string, name string")
    added = L.dim_append_new(spark, batch, path, "key")
    assert [tuple(r) for r in added.collect()] == [("k3", "C")]
    assert L.dim_append_new(spark, batch, path, "key").count() == 0
    stored = dict(map(tuple, spark.read.parquet(path).collect()))
    assert stored == {"k1": "A", "k2": "B", "k3": "C"}  # SCD0: existing keys never updated


def test_load_once(spark, tmp_path):
    path = str(tmp_path / "dim_date")
    cal = G.calendar(spark, "2024-01-01", "2024-01-10")
    assert L.load_once(spark, cal, path) is True and L.load_once(spark, cal, path) is False


def test_ledger_takes_each_file_once(spark, tmp_path):
    folder, ledger = str(tmp_path / "in [a]%20 b"), str(tmp_path / "ledger {1}")  # a path that readers must not expand
    put = lambda rows: spark.createDataFrame(rows, "batch_id string, x int").coalesce(1).write.mode("append").partitionBy("batch_id").parquet(folder)
    put([("b1", 1), ("b1", 2), (None, 3)])
    run = ledgers.claim(spark, folder, ledger)
    assert sorted(r.x for r in ledgers.read_run(spark, run, folder).collect()) == [1, 2, 3]
    put([("b1", 4), ("b2", 5)])
    assert ledgers.claim(spark, folder, ledger) == run  # it did not finish: the same files, not the new ones
    ledgers.finish(spark, ledger, run.run_id)
    late = ledgers.claim(spark, folder, ledger)  # a file of a batch that was taken, and a new batch
    assert late.run_id > run.run_id and sorted(map(tuple, ledgers.read_run(spark, late, folder).collect())) == [(4, "b1"), (5, "b2")]
    ledgers.finish(spark, ledger, late.run_id)
    assert ledgers.claim(spark, folder, ledger) is None and ledgers.finished(spark, ledger) == {run.run_id, late.run_id}
    victim = sorted(late.paths)[0].removeprefix("file:")
    os.utime(victim, (1, 1))  # replaced by a file of another time
    assert [p.removeprefix("file:") for p in ledgers.claim(spark, folder, ledger).paths] == [victim]


def test_publish_tables(spark, tmp_path):
    p = str(tmp_path / "stats")
    L.write_json(spark.createDataFrame([(1.0, 2)], "AverageEnergy double, TotalRecords long"), p)
    assert L.publish_tables(spark, {p: "pub_stats_test"}) == ["pub_stats_test"]
    assert spark.table("pub_stats_test").first()["TotalRecords"] == 2


def test_merge_rejects_duplicate_source_keys_and_keeps_null_ones(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    with pytest.raises(Exception, match="more than one row for key a"):
        L.merge_upsert(target, spark.createDataFrame([("a", 5), ("a", 6)], "k string, v int"), "k").collect()
    got = L.merge_upsert(target, spark.createDataFrame([("a", 5), (None, 6), (None, 7)], "k string, v int"), "k")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", 5), ("b", 2), (None, 3), (None, 6), (None, 7)], key=str)


def test_merge_rewrites_touched_partitions_only(spark):
    table = f"fact_parts_{uuid.uuid4().hex[:8]}"
    rows = [(f"r{i}", i % 4, float(i)) for i in range(40)]
    target = spark.createDataFrame(rows, "RecordID string, date_key int, e double")
    assert L.merge_into_table(spark, target, table, "RecordID", partition="date_key") == "created"
    before = {f: f.split("date_key=")[1][0] for f in spark.table(table).inputFiles()}
    source = spark.createDataFrame([("r1", 1, -1.0), ("r5", 2, -5.0), ("new", 2, 9.0)], "RecordID string, date_key int, e double")
    assert L.merge_into_table(spark, source, table, "RecordID", partition="date_key") == "merged"
    after = set(spark.table(table).inputFiles())
    assert {f for f, part in before.items() if part in "03"} <= after  # untouched files keep their names
    assert not {f for f, part in before.items() if part in "12"} & after
    got = {r.RecordID: (r.date_key, r.e) for r in spark.table(table).collect()}
    want = {**{k: (d, e) for k, d, e in rows}, "r1": (1, -1.0), "r5": (2, -5.0), "new": (2, 9.0)}
    assert got == want and spark.table(table).count() == 41
    assert L.merge_into_table(spark, source.limit(0), table, "RecordID", partition="date_key") == "skipped"
    everything = spark.createDataFrame([(k, 7, e) for k, (d, e) in want.items() if d == 3], "RecordID string, date_key int, e double")
    L.merge_into_table(spark, everything, table, "RecordID", partition="date_key")  # day 3 loses all of its rows
    assert spark.table(table).filter("date_key = 3").count() == 0 and spark.table(table).count() == 41
    spark.sql(f"DROP TABLE {table}")


def test_bucketed_merge_shuffles_no_target_and_rewrites_touched_buckets(spark):
    table = f"fact_buckets_{uuid.uuid4().hex[:8]}"
    schema = "RecordID string, v int"
    rows = {f"r{i}": i for i in range(60)}
    target = spark.createDataFrame([*rows.items(), (None, -1)], schema)
    assert L.merge_into_table(spark, target, table, "RecordID", buckets=16) == "created" and L.buckets_of(spark, table) == 16
    before = {f: int(f.split(f"{L.BUCKET}=")[1].split("/")[0]) for f in spark.table(table).inputFiles()}
    assert len(before) == len(set(before.values()))  # a file for each bucket
    source = spark.createDataFrame([("r1", 100), ("r2", 200), ("new", 300)], schema)
    touched = {r[0] for r in source.select(L.bucket_of("RecordID", 16)).collect()}
    staged = source.withColumn(L.BUCKET, L.bucket_of("RecordID", 16))
    plan = L.merged_buckets(spark.table(table), staged, "RecordID")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and plan.count("Exchange ") == 1  # the source's alone
    assert L.merge_into_table(spark, source, table, "RecordID", buckets=16) == "merged"
    after = set(spark.table(table).inputFiles())
    assert {f for f, b in before.items() if b not in touched} <= after and not {f for f, b in before.items() if b in touched} & after
    assert len(after) == len({f.split(f"{L.BUCKET}=")[1].split("/")[0] for f in after})  # still a file for each bucket
    got = sorted(map(tuple, spark.table(table).drop(L.BUCKET).collect()), key=str)
    assert got == sorted([*{**rows, "r1": 100, "r2": 200, "new": 300}.items(), (None, -1)], key=str)
    nulls = spark.createDataFrame([(None, -2), (None, -3)], schema)
    L.merge_into_table(spark, nulls, table, "RecordID", buckets=16)  # NULL keys never match
    assert sorted(r.v for r in spark.table(table).where("RecordID is null").collect()) == [-3, -2, -1]
    assert L.merge_into_table(spark, source.limit(0), table, "RecordID", buckets=16) == "skipped"
    with pytest.raises(Exception, match="more than one row for key"):
        L.merge_into_table(spark, source.union(source), table, "RecordID", buckets=16)
    assert spark.table(table).count() == 64
    spark.sql(f"DROP TABLE {table}")


def test_swap_keeps_the_old_version_until_the_new_one_is_written(spark):
    table = f"swapped_{uuid.uuid4().hex[:8]}"
    L.swap_in(spark, spark.range(3).toDF("x"), table)
    broken = spark.range(5).select(F.raise_error(F.lit("broken")).cast("bigint").alias("x"))
    with pytest.raises(Exception, match="broken"):
        L.swap_in(spark, broken, table)
    assert spark.table(table).count() == 3
    planned = spark.table(table)  # before the swap
    L.swap_in(spark, spark.range(9).toDF("x"), table)
    assert spark.table(table).count() == 9
    assert sorted(r.x for r in planned.collect()) == [0, 1, 2]  # it still reads its version
    assert L.vacuum(spark, table, retain_seconds=3600) == [] and planned.count() == 3
    assert len(L.vacuum(spark, table, retain_seconds=0)) == 2  # the replaced version, and what the broken swap left
    assert spark.table(table).count() == 9 and L.vacuum(spark, table, retain_seconds=0) == []
    spark.sql(f"DROP TABLE {table}")


def test_vacuum_removes_a_first_version_made_by_other_means(spark):
    table = f"swapped_{uuid.uuid4().hex[:8]}"
    L.replace_table(spark.range(2).toDF("x"), table)
    first = L._location(spark, table)
    L.swap_in(spark, spark.range(4).toDF("x"), table)
    assert L.vacuum(spark, table, retain_seconds=0) == [first] and not L.path_exists(spark, first)
    assert spark.table(table).count() == 4
    spark.sql(f"DROP TABLE {table}")


def test_empty_dimensions_leave_the_loaded_ones(spark):
    table = f"dim_{uuid.uuid4().hex[:8]}"
    L.replace_table(spark.range(2), table)
    assert not L.replace_unless_empty(spark.range(0), table) and spark.table(table).count() == 2


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from joulebox.session import scratch_folder

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder("spark://host:7077")
    assert os.path.isdir(scratch_folder("local[4]"))
