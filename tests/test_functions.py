import hashlib
import math

from pyspark.sql import functions as F

from joulebox import functions as J


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_initcap_and_acronyms(spark):
    rows = [("  central ac ",), ("split ac",), ("NO HVAC",), ("vrf",), ("heat pump",), ("",), ("   ",), ("NaN",), (None,)]
    df = spark.createDataFrame(rows, "x string")
    got = [r[0] for r in df.select(J.normalize_hvac("x")).collect()]
    assert got == ["Central AC", "Split AC", "No HVAC", "VRF", "Heat Pump", None, None, "Nan", None]


def test_nan_token_option(spark):
    df = spark.createDataFrame([("nan",), ("NaN",), (" office ",)], "x string")
    got = [r[0] for r in df.select(J.normalize_category("x", ("", "nan"))).collect()]
    assert got == [None, None, "Office"]


def test_nonfinite_to_null(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(J.nonfinite_to_null("x")).collect()] == [1.5, None, None, None, None]
    text = spark.createDataFrame([("12.5",), ("abc",), ("NaN",), ("Infinity",)], "x string")
    assert [r[0] for r in text.select(J.nonfinite_to_null("x")).collect()] == [12.5, None, None, None]


def test_nan_must_be_nulled_before_floor(spark):
    # T2: floor(NaN) cast to int would be 0 and pass ">= 0"; nulling first keeps it out
    df = spark.createDataFrame([(float("nan"),), (3.9,), (1e30,)], "x double")
    got = [r[0] for r in df.select(J.floor_int(J.nonfinite_to_null("x"))).collect()]
    assert got == [None, 3, None]


def test_safe_divide_and_clamp(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(J.safe_divide("a", "b")).collect()] == [None, 2.5, None]
    dev = spark.createDataFrame([(None,), (-30.0,), (20.0,), (250.0,)], "d double")
    # T6: a NULL deviation stays NULL instead of scoring 100
    assert [r[0] for r in dev.select(J.clamp_health_score("d")).collect()] == [None, 100.0, 80.0, 0.0]


def test_deviation_message(spark):
    df = spark.createDataFrame([(12.35,), (-7.0,), (0.0,)], "d double")
    got = [r[0] for r in df.select(J.deviation_message("d")).collect()]
    assert got == [
        "Energy consumption is 12.4% higher than predicted",
        "Energy consumption is 7.0% lower than predicted",
        "Energy consumption is 0.0% lower than predicted",
    ]


def test_dates(spark):
    df = spark.createDataFrame([("2024-05-17",), ("2024-13-40",), (None,)], "x string")
    got = df.select(J.parse_date("x").alias("d")).select(J.date_key("d")).collect()
    assert [r[0] for r in got] == [20240517, None, None]  # T5: bad date -> NULL, no failure
    parts = spark.createDataFrame([("2024-01-06",)], "x string").select(*J.date_parts(J.parse_date("x"))).first()
    assert parts["day_name"] == "Saturday" and parts["day_of_week"] == 7 and parts["is_weekend"] is True
    assert parts["week_of_year"] == 1 and parts["quarter"] == 1


def test_md5_key_and_ids(spark):
    assert one(spark, F.md5("x"), "Office") == hashlib.md5(b"Office").hexdigest()
    assert one(spark, J.record_id("x"), 123, "x long") == "REC-000123"
    assert one(spark, J.batch_id("x"), 7, "x long") == "POWER-BATCH-0007"


def test_round_matches_decimal_half_up(spark):
    v = 22903.05 / 24
    got = one(spark, F.round("x", 4), v, "x double")
    assert math.isclose(got, 954.2937)
