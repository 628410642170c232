import pytest
from pyspark.sql import functions as F

from joulebox.operators.cleaning import EmptyResultError, MissingColumnsError, fail_if_empty, require_columns
from joulebox.operators.dedup import dedup_key
from joulebox.plans import readings as R

COLS = "RoomArea string, NumberofAppliances double, `Outside Temperature` double, InsulationThickness double, " \
       "BuildingType string, HVACSystem string, AverageTemperature double, EnergyConsumption double"


def base(i, **kw):
    row = dict(RoomArea=str(50 + i % 7), NumberofAppliances=5.7, **{"Outside Temperature": 10.0}, InsulationThickness=2.0,
               BuildingType=" office ", HVACSystem="central ac", AverageTemperature=22.0, EnergyConsumption=1000.0 + (i % 13) * 10)
    row.update(kw)
    return row


def frame(spark, rows):
    order = ["RoomArea", "NumberofAppliances", "Outside Temperature", "InsulationThickness", "BuildingType", "HVACSystem",
             "AverageTemperature", "EnergyConsumption"]
    return spark.createDataFrame([tuple(r[c] for c in order) for r in rows], COLS)


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [base(i) for i in range(60)]
    rows += [base(0)]  # exact duplicate of row 0
    rows += [
        base(100, EnergyConsumption=float("nan")),
        base(101, EnergyConsumption=float("inf")),
        base(102, RoomArea="-inf"),
        base(103, BuildingType=""),
        base(104, BuildingType="   "),
        base(105, BuildingType="NaN"),  # kept as 'Nan' (T1)
        base(106, **{"Outside Temperature": -50.0}),
        base(107, **{"Outside Temperature": 60.0}),
        base(108, **{"Outside Temperature": 60.5}),
        base(109, AverageTemperature=-30.0),
        base(110, AverageTemperature=50.1),
        base(111, RoomArea="0"),
        base(112, EnergyConsumption=0.0),
        base(113, NumberofAppliances=-0.5),
        base(114, EnergyConsumption=1e7),  # IQR outlier
        base(115, RoomArea="abc"),
    ]
    return frame(spark, rows)


def test_clean_readings_rules(spark, dirty):
    out = R.clean_readings(dirty, iqr_mode="exact")
    rows = out.collect()
    assert out.columns[2] == "OutsideTemperature"
    assert dict(out.dtypes)["NumberofAppliances"] == "int" and dict(out.dtypes)["RoomArea"] == "double"
    temps = {r["OutsideTemperature"] for r in rows}
    assert -50.0 in temps and 60.0 in temps and 60.5 not in temps
    assert -30.0 in {r["AverageTemperature"] for r in rows}
    assert 1e7 not in {r["EnergyConsumption"] for r in rows}
    assert {r["BuildingType"] for r in rows} == {"Office", "Nan"}
    assert {r["HVACSystem"] for r in rows} == {"Central AC"}
    assert all(r["NumberofAppliances"] == 5 for r in rows)
    assert len(rows) == 60 + 4  # 60 distinct clean + NaN category + 3 range edges kept


def test_stage_report_accounts_for_every_row(spark, dirty):
    rep = R.stage_report(dirty, iqr_mode="exact").first()
    removed = sum(rep[c] for c in ["duplicates_removed", "missing_removed", "invalid_removed", "temperature_removed", "outliers_removed"])
    assert rep["raw_records"] == dirty.count() == removed + rep["clean_records"]
    # the exact copy, plus two rows that become identical once '-inf' and 'abc' are NULL
    assert rep["duplicates_removed"] == 2 and rep["clean_records"] == R.clean_readings(dirty, iqr_mode="exact").count()
    assert rep["outliers_removed"] == 1 and rep["temperature_removed"] == 2


def test_exact_rules_idempotent(spark, dirty):
    once = R.clean_readings(dirty, iqr_mode="exact")
    twice = R.clean_readings(once.withColumnRenamed("OutsideTemperature", "Outside Temperature"), iqr_mode="exact")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_features(spark, dirty):
    f = R.add_features(R.clean_readings(dirty, iqr_mode="approx"))
    r = f.filter(F.col("RoomArea") == 50).first()
    assert r["EnergyPerArea"] == round(r["EnergyConsumption"] / 50, 4)
    assert r["TemperatureDifference"] == 12.0


def test_require_and_fail(spark, dirty):
    with pytest.raises(MissingColumnsError):
        require_columns(dirty, ["RoomArea", "EnergyPerArea"])
    with pytest.raises(EmptyResultError):
        fail_if_empty(dirty.filter(F.lit(False)), "no records remained")


def test_dedup_key_is_deterministic(spark):
    rows = [("a", 3, None), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q"), ("b", 2, "p"), (None, 5, "n"), (None, 4, "m")]
    df = spark.createDataFrame(rows, "k string, v int, s string")
    picks = {tuple(r) for r in dedup_key(df, "k").collect()}
    assert picks == {("a", 1, "y"), ("b", None, "q"), (None, 4, "m")}
    for n in (1, 3, 7):
        assert {tuple(r) for r in dedup_key(df.repartition(n), "k").collect()} == picks


def test_lookups(spark):
    from joulebox.operators.joins import lookup_keys, lookup_with_default, new_keys

    dim = spark.createDataFrame([("a", "k1"), ("b", "k2")], "name string, key string")
    fact = spark.createDataFrame([("a", 1), ("c", 2), (None, 3)], "name string, v int")
    got = sorted(map(tuple, lookup_keys(fact, dim, "name").collect()), key=str)
    assert got == sorted([("a", 1, "k1"), ("c", 2, None), (None, 3, None)], key=str)
    assert [r["name"] for r in new_keys(fact, dim, "name").collect() if r["name"]] == ["c"]
    filled = {r["name"]: r["key"] for r in lookup_with_default(fact, dim, "name", {"key": "none"}).collect()}
    assert filled["c"] == "none" and filled["a"] == "k1"
