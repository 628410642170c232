"""What grows with the tables: partitions, files, bytes written, rows of a task."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from joulebox.operators import dedup, indexing
from joulebox.plans import loading
from joulebox.sources import files, topic


def test_partitions_follow_the_tables_read_and_not_a_joins_estimate(spark, tmp_path, monkeypatch):
    for name in ("left", "right"):
        spark.range(20_000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias(name)).write.parquet(f"{tmp_path}/{name}")
    left, right = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("left", "right"))
    joined = left.join(right, "k")
    monkeypatch.setattr(indexing, "PARTITION_BYTES", 100_000)
    one = indexing.partitions_for(left)
    assert one > 1
    assert abs(indexing.partitions_for(joined) - one - indexing.partitions_for(right)) <= 1
    assert indexing.partitions_for(spark.createDataFrame([(1,)], "k long")) == 1


def test_topic_files_are_short(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topic, "ROWS_PER_FILE", 10)
    topic.publish(spark.range(300).repartition(1), f"{tmp_path}/topic", ["id"], partitions=2)
    rows = spark.read.parquet(f"{tmp_path}/topic/log/*").groupBy(F.expr("_metadata.file_path")).count().collect()
    assert max(r["count"] for r in rows) <= 10
    assert sum(r["count"] for r in rows) == 300


def test_topic_records_lie_in_short_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topic, "ROWS_PER_GROUP", 10)
    topic.publish(spark.range(300).repartition(1), f"{tmp_path}/topic", ["id"], partitions=2)
    groups = [pq.ParquetFile(f).metadata for f in (tmp_path / "topic" / "log").rglob("part-*.parquet")]
    assert max(m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups)) <= 10
    assert sum(m.num_rows for m in groups) == 300


def test_micro_batches_are_dealt_to_all_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topic, "ROWS_PER_RANGE", 10)
    topic.publish(spark.range(300), f"{tmp_path}/topic", ["id"])
    reader = topic.TopicReader({"path": f"{tmp_path}/topic", "minpartitions": "8"})
    runs = reader.partitions({"0": 10}, {"0": 100, "1": 100, "2": 50})
    read = [[(p, o) for b in reader.read(r) for p, o in zip(b["partition"].to_pylist(), b["offset"].to_pylist(), strict=True)] for r in runs]
    assert len(runs) == 8 and {len(r) for r in read} == {30}
    assert sorted(x for r in read for x in r) == [(p, o) for p, lo, hi in ((0, 10, 100), (1, 0, 100), (2, 0, 50)) for o in range(lo, hi)]


def test_runs_of_a_micro_batch(monkeypatch):
    monkeypatch.setattr(topic, "ROWS_PER_RANGE", 10)
    monkeypatch.setattr(topic, "ROWS_PER_TASK", 40)
    assert topic.cut({}, {"0": 3, "1": 4}, 8) == [[("0", 0, 3), ("1", 0, 4)]]  # few rows: one task
    assert topic.cut({"0": 5}, {"0": 5, "1": 0}, 8) == [] and topic.cut({}, {}, 8) == []
    assert topic.cut({"0": 2}, {"0": 22, "1": 20}, 2) == [[("0", 2, 22)], [("1", 0, 20)]]
    assert topic.cut({}, {"0": 100}, 1) == [[("0", 0, 33)], [("0", 33, 66)], [("0", 66, 100)]]  # long ones are cut


def test_json_is_written_compressed_in_short_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loading, "JSON_ROWS_PER_FILE", 100)
    rows = spark.range(250).select(F.col("id"), F.lit("a text that repeats").alias("text")).repartition(1)
    loading.write_json(rows, f"{tmp_path}/out")
    assert len(list((tmp_path / "out").glob("part-*.json.gz"))) == 3
    assert {tuple(r) for r in spark.read.schema(rows.schema).json(f"{tmp_path}/out").collect()} == {tuple(r) for r in rows.collect()}


def test_stored_json_lines_are_packed_by_zstd(spark, tmp_path):
    loading.write_json(spark.range(20), f"{tmp_path}/in")
    stored = files.read_json_stored(spark, f"{tmp_path}/in")
    assert {pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(0).column(0).compression for f in stored.inputFiles()} == {"ZSTD"}
    assert {r["id"] for r in stored.collect()} == set(range(20))


def test_ranks_of_quantiles_are_not_dealt_by_column(spark):
    from joulebox.queries.q_cleaning import APPROX_COLUMNS, within

    feats = spark.range(100).select(*[F.col("id").cast("double").alias(c) for c in APPROX_COLUMNS])
    got = spark.createDataFrame([(c, 0.5, 50.0) for c in APPROX_COLUMNS], "column string, probability double, value double")
    with_conf = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        checked = within(feats, got)
        assert "SortMergeJoin" not in checked._jdf.queryExecution().executedPlan().toString()
        assert [(r["n"], r["within"]) for r in checked.collect()] == [(100, True)] * 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_conf)


def test_large_tables_are_deduplicated_in_more_tasks_with_the_same_rows(spark, monkeypatch):
    key = F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 50)  # a third of the rows share the NULL key
    rows = spark.range(1200).select(key.alias("k"), (F.col("id") % 7).cast("double").alias("v"), F.when(F.col("id") % 5 > 0, F.lit(-0.0)).otherwise(0.0).alias("z"))
    plain_key, plain_rows = (sorted(map(repr, d.collect())) for d in (dedup.dedup_key(rows, "k"), dedup.dedup_rows_counted(rows)))
    monkeypatch.setattr(dedup, "partitions_for", lambda df: 20)
    for found, plain in ((dedup.dedup_key(rows, "k"), plain_key), (dedup.dedup_rows_counted(rows), plain_rows)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(_hash") == 2 and plan.count("Exchange") == 2 and ", 20)" in plan
        assert sorted(map(repr, found.collect())) == plain
