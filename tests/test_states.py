import random

import pytest
from pyspark.sql import functions as F

from joulebox.operators.aggregates import energy_by, energy_statistics
from joulebox.plans import states

COLUMNS = "day string, BuildingType string, HVACSystem string, EnergyConsumption double, EnergyPerArea double"


def readings(n, days, seed):
    rng = random.Random(seed)
    kinds, systems = ["Office", "Lab", None], ["VRF", "No HVAC"]
    return [(rng.choice(days), rng.choice(kinds), rng.choice(systems), float(rng.randrange(10_000)), rng.choice([None, float(rng.randrange(64)) / 8])) for _ in range(n)]


def same(spark, path, rows):
    stored, whole = spark.read.parquet(path), spark.createDataFrame(rows, COLUMNS)
    assert sorted(map(tuple, states.energy_by(stored, "BuildingType").collect()), key=str) == sorted(map(tuple, energy_by(whole, "BuildingType").collect()), key=str)
    assert [tuple(r) for r in states.energy_statistics(stored).collect()] == [tuple(r) for r in energy_statistics(whole).collect()]


def test_states_of_batches_equal_the_whole_aggregate(spark, tmp_path):
    path, days = str(tmp_path / "states"), ["d1", "d2", "d3", None]
    batches = [readings(50, days[:2], 1), readings(70, days[1:], 2), readings(30, days, 3)]
    frame = lambda rows: states.energy_states(spark.createDataFrame(rows, COLUMNS), F.col("day"))
    for i, rows in enumerate(batches):
        states.add_batch(spark, path, frame(rows), f"B{i}")
    same(spark, path, sum(batches, []))
    of_d3 = lambda: {f for f in spark.read.parquet(path).inputFiles() if "part=d3" in f}
    untouched = of_d3()
    batches[0] = readings(20, ["d1"], 4)  # added again with other rows, none of them of d2
    states.add_batch(spark, path, frame(batches[0]), "B0")
    same(spark, path, sum(batches, []))
    assert untouched and of_d3() == untouched  # only touched parts are rewritten
    again = readings(15, ["d2"], 5)
    states.replace_parts(spark, path, frame(again), "fix")  # a day's state is replaced as a whole
    same(spark, path, [r for r in sum(batches, []) if r[0] != "d2"] + again)
    only = str(tmp_path / "only")
    states.add_batch(spark, only, frame(readings(5, ["d1"], 6)), "B0")
    states.add_batch(spark, only, frame(readings(5, ["d2"], 7)), "B0")  # the batch has left d1
    same(spark, only, readings(5, ["d2"], 7))
    assert {r[0] for r in spark.read.parquet(only).select("part").collect()} == {"d2"}


def test_sketches_merge_within_their_rank_error(spark, tmp_path):
    rng = random.Random(1)
    values = [rng.lognormvariate(0, 2) for _ in range(30_000)] + [5.0] * 9_000 + [float("nan"), None]
    frame = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "b int, x double")
    path = str(tmp_path / "sketches")
    for b in range(3):
        states.add_batch(spark, path, states.sketches(frame.where(F.col("b") == b), F.lit("d"), ["x"]), f"B{b}")
    stored = spark.read.parquet(path)
    known = sorted(v for v in values if v is not None and v == v)
    assert stored.agg(F.sum("rows")).first()[0] == len(known)
    for r in states.sketched_quantiles(stored, [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]).collect():
        below, upto = sum(v < r.value for v in known) / len(known), sum(v <= r.value for v in known) / len(known)
        assert below - 0.01 <= r.probability <= upto + 0.01
    low, high = states.sketched_bounds(stored).select("lower", "upper").first()
    q1, q3 = known[len(known) // 4], known[3 * len(known) // 4]
    assert low == pytest.approx(q1 - 3 * (q3 - q1), rel=0.1) and high == pytest.approx(q3 + 3 * (q3 - q1), rel=0.1)
