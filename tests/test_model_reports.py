import pytest
from pyspark.sql import functions as F

from joulebox.operators.aggregates import accuracy_report, regression_metrics
from joulebox.plans import model as M
from joulebox.plans import reports as P
from joulebox.schema import STATUS_ABOVE, STATUS_BELOW, STATUS_NORMAL

PRED = "EnergyConsumption double, prediction double, BuildingType string, HVACSystem string, RoomArea double, " \
       "NumberofAppliances int, InsulationThickness double, EnergyPerArea double"


def pred_rows(spark, pairs, btype="Office", hvac="VRF"):
    return spark.createDataFrame([(a, p, btype, hvac, 10.0, 2, 1.0, a / 10) for a, p in pairs], PRED)


def test_health_status_cuts_and_nulls(spark):
    pairs = [(100.0 + i, 100.0) for i in range(-20, 21)] + [(50.0, 0.0), (80.0, -100.0)]
    h = {(r["ActualEnergy"], r["ExpectedEnergy"]): r for r in M.building_health(pred_rows(spark, pairs), mode="exact").collect()}
    assert h[(50.0, 0.0)]["DeviationPercent"] is None and h[(50.0, 0.0)]["EfficiencyStatus"] == STATUS_NORMAL  # T17
    assert h[(80.0, -100.0)]["DeviationPercent"] == -180.0  # negative prediction flips the sign
    assert h[(120.0, 100.0)]["EfficiencyStatus"] == STATUS_ABOVE
    assert h[(80.0, -100.0)]["EfficiencyStatus"] == STATUS_BELOW
    assert h[(100.0, 100.0)]["EfficiencyStatus"] == STATUS_NORMAL


def test_metrics_agree_with_mllib(spark):
    df = pred_rows(spark, [(float(a), float(a) * 0.9 + 3) for a in range(1, 200)])
    ours = regression_metrics(df, "EnergyConsumption", "prediction").first()
    ml = M.evaluate(df)
    for k in ("rmse", "mae", "r2"):
        assert ours[k] == pytest.approx(ml[k], rel=1e-9)


def test_accuracy_report_edges(spark):
    empty = spark.createDataFrame([], "actual double, predicted double")
    assert tuple(accuracy_report(empty).first()) == (0.0, 0.0, 0.0, 0.0)
    zero = spark.createDataFrame([(0.0, 2.0), (0.0, 1.0)], "actual double, predicted double")
    r = accuracy_report(zero).first()
    assert r["mape"] == pytest.approx(150.0) and r["r2"] == 0.0  # divisor 1 when actual is 0; SStot 0 -> 0


HEALTH = "BuildingType string, HVACSystem string, RoomArea double, NumberofAppliances int, InsulationThickness double, " \
         "EnergyPerArea double, ActualEnergy double, ExpectedEnergy double, DeviationPercent double, EfficiencyStatus string"


def health_rows(spark, rows):
    return spark.createDataFrame([(b, h, 1.0, 1, 1.0, 1.0, 1.0, 1.0, d, s) for b, h, d, s in rows], HEALTH)


def test_reports_traps(spark):
    health = health_rows(spark, [
        ("Office", "VRF", 60.0, STATUS_ABOVE), ("Office", "VRF", 30.0, STATUS_ABOVE), ("Office", "VRF", None, STATUS_NORMAL),
        ("Shop", "VRF", 100.0, STATUS_ABOVE), ("Shop", "VRF", 100.0, STATUS_ABOVE), ("Nan", "VRF", 999.0, STATUS_ABOVE),
        ("Home", "Nan", -999.0, STATUS_BELOW),
    ])
    readings = spark.createDataFrame(
        [("Office", "VRF", 1000.0, 10.0), ("Shop", "VRF", 900.0, 9.25), ("Depot", "VRF", 800.0, 8.0), ("Nan", "VRF", 5000.0, 1.0)],
        "BuildingType string, HVACSystem string, EnergyConsumption double, EnergyPerArea double",
    )
    top = {r["buildingType"]: r for r in P.top_types(readings, health).collect()}
    assert set(top) == {"Office", "Shop", "Depot"}  # 'Nan' excluded
    assert top["Office"]["riskLevel"] == "High" and top["Office"]["healthScore"] == 55  # avg(40, 70); NULL not scored
    assert top["Shop"]["healthScore"] == 75  # a true 0 score becomes 75 (T16)
    assert top["Depot"]["healthScore"] == 75 and top["Depot"]["riskLevel"] == "Low"  # no health rows
    assert top["Shop"]["energyPerArea"] == 9.3
    alerts = P.alerts(health).collect()
    assert alerts[0]["buildingType"] == "Office" and alerts[0]["severity"] == "info"  # NULL first (T7)
    assert [a["severity"] for a in alerts[1:]] == ["critical", "critical", "critical", "warning"]
    assert alerts[1]["message"] == "Energy consumption is 100.0% higher than predicted"
    dist = dict(map(tuple, P.health_distribution(health).collect()))
    assert dist == {"Critical": 3, "Warning": 1, "Healthy": 1}
    share = {r["name"]: r["percent"] for r in P.health_share(health).collect()}
    assert share == {"Critical": 60, "Warning": 20, "Healthy": 20}
    k = P.kpis(readings, health, building_type="Nobody").first()
    assert (k["total_energy"], k["building_types"], k["total_records"]) == (0.0, 0, 0)


def test_fast_and_detail_routes_differ_on_nan_hvac(spark):
    readings = spark.createDataFrame(
        [("Office", "VRF", 100.0, 1.0), ("Office", "Nan", 50.0, 1.0)],
        "BuildingType string, HVACSystem string, EnergyConsumption double, EnergyPerArea double",
    )
    pre = readings.groupBy("BuildingType").agg(F.sum("EnergyConsumption").alias("TotalEnergy"))
    fast = P.energy_by_type(readings, pre).first()["value"]
    detail = P.energy_by_type(readings, pre, hvac_system="VRF").first()["value"]
    assert (fast, detail) == (150.0, 100.0)  # T12: the pre-aggregate includes the 'Nan' HVAC rows


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["BuildingType", "RecordCount", "AverageEnergy", "TotalEnergy", "AverageEnergyPerArea"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 113


def _readings(spark, n=400):
    import random

    rng = random.Random(8)
    rows = []
    for _ in range(n):
        kind, hvac = rng.choice(["Office", "Lab", "Store", "Home"]), rng.choice(["VRF", "No HVAC"])
        avg, out = rng.uniform(15, 30), rng.uniform(-10, 40)
        area, appliances, thick = rng.uniform(5, 50), rng.randrange(1, 20), rng.uniform(0, 9)
        energy = 900.0 + 12 * area + 3 * appliances - 5 * thick + 2 * (out - avg) + {"Office": 40, "Lab": 90, "Store": 0, "Home": -30}[kind] + rng.gauss(0, 5)
        rows.append((area, appliances, out, thick, kind, hvac, avg, energy, energy / area, abs(out - avg)))
    return spark.createDataFrame(rows, "RoomArea double, NumberofAppliances int, OutsideTemperature double, InsulationThickness double, BuildingType string, "
                                       "HVACSystem string, AverageTemperature double, EnergyConsumption double, EnergyPerArea double, TemperatureDifference double")


def test_ridge_in_closed_form_equals_mllib(spark):

    rows = _readings(spark).repartition(5)
    own, mllib = M.fit_ridge(rows), M.fit_energy_model(rows)
    lr = mllib.stages[-1]
    labels = [f"{c}={v}" for c, values in zip(M.CATEGORIES, mllib.stages[0].labelsArray, strict=True) for v in values]
    theirs = dict(zip([*M.NUMBERS, *labels, "intercept"], [*lr.coefficients.toArray().tolist(), lr.intercept], strict=True))
    assert {t: round(b, 2) for t, b in own.terms()} == pytest.approx({t: round(b, 2) for t, b in theirs.items()}, abs=0.011)
    assert max(abs(g) for _, g in M.optimality(own, rows)) < 1e-9
    unseen = rows.limit(3).withColumn("BuildingType", F.lit("Barn")).withColumn("HVACSystem", F.lit(None).cast("string"))
    for probe in (rows, unseen):
        a, b = (sorted(r.prediction for r in p.collect()) for p in (own.predictions(probe), M.predictions(mllib, probe)))
        assert a == pytest.approx(b, abs=1e-6)
    assert M.evaluate(own.predictions(rows))["r2"] > 0.99


def test_ridge_edge_cases(spark):
    from joulebox.operators.cleaning import EmptyResultError

    rows = _readings(spark, 30)
    with pytest.raises(EmptyResultError):
        M.fit_ridge(rows.limit(0))
    flat = rows.withColumn("RoomArea", F.lit(10.0)).withColumn("HVACSystem", F.lit("VRF"))  # inputs that never change have no weight
    model = M.fit_ridge(flat)
    assert model.numbers["RoomArea"] == 0 and model.effects["HVACSystem"] == {"VRF": 0.0}
    level = M.fit_ridge(rows.withColumn("EnergyConsumption", F.lit(7.0)))
    assert level.intercept == 7.0 and set(level.numbers.values()) == {0.0}


def test_ridge_of_two_inputs_by_cramers_rule(spark):
    import numpy as np


    rows = _readings(spark)
    x1, x2, y = (np.array(c) for c in zip(*[(r.RoomArea, r.NumberofAppliances, r.EnergyConsumption) for r in rows.collect()], strict=True))
    r12, r1, r2 = np.corrcoef(x1, x2)[0, 1], np.corrcoef(x1, y)[0, 1], np.corrcoef(x2, y)[0, 1]
    p = 1 + 0.1 / y.std()
    b1 = (p * r1 - r12 * r2) / (p * p - r12 * r12) * y.std() / x1.std()
    b2 = (p * r2 - r12 * r1) / (p * p - r12 * r12) * y.std() / x2.std()
    lr = M.fit_numeric_model(rows, ["RoomArea", "NumberofAppliances"]).stages[-1]
    assert lr.coefficients.toArray().tolist() == pytest.approx([b1, b2]) and lr.intercept == pytest.approx(y.mean() - b1 * x1.mean() - b2 * x2.mean())


def test_dictionary_equals_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    rows = spark.range(250_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.pmod(F.xxhash64("id"), F.lit(100_000)))).alias("key"))
    probe = spark.createDataFrame([("hot", 1.0), ("k5", 2.0), ("none such", 3.0), (None, 4.0)], "key string, `index` double").unionByName(rows.limit(500).withColumn("index", F.lit(0.0)))
    dictionary = M.category_dictionary(rows, "key")
    assert dictionary.count() > 80_000
    theirs = StringIndexer(inputCol="key", outputCol="i", handleInvalid="keep").fit(rows).transform(probe)
    ours = M.index_by(probe, dictionary, "key", "i")
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(map(tuple, theirs.collect()), key=str)
    big = M.index_by(rows, dictionary, "key", "i")._jdf.queryExecution().executedPlan().toString()
    assert "Collect" not in big
