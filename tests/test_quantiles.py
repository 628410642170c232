import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from joulebox.operators import quantiles as Q


def np_quantile(values, p):
    return float(np.quantile(np.array(values, dtype=float), p, method="linear"))


def test_exact_quantiles_match_numpy_with_skew(spark):
    rng = np.random.default_rng(7)
    hot = [42.0] * 3000  # a value holding a third of all rows
    vals = list(rng.lognormal(3, 1.2, 6000)) + hot
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = Q.exact_quantiles(df, ["x"], probs, buckets=64)  # small buckets force several rounds
    for p in probs:
        assert got[("x", p)] == np_quantile(vals, p)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=60))
def test_exact_quantiles_property(spark, vals):
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = Q.exact_quantiles(df, ["x"], [0.25, 0.75], buckets=4)
    for p in (0.25, 0.75):
        assert abs(got[("x", p)] - np_quantile(vals, p)) <= 1e-9 * max(1.0, abs(np_quantile(vals, p)))


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    got = Q.exact_quantiles(df, ["a", "b"], [0.5])
    assert got[("a", 0.5)] is None and got[("b", 0.5)] == 1.5
    bounds = Q.iqr_bounds(df, ["a", "b"], mode="approx")
    assert bounds["a"] is None  # no quantiles: the rule is skipped


def test_iqr_factor_three(spark):
    vals = [float(v) for v in range(1, 101)] + [400.0, 1000.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    kept = {r[0] for r in Q.iqr_filter(df, ["x"], 3.0, mode="exact").collect()}
    q1, q3 = np_quantile(vals, 0.25), np_quantile(vals, 0.75)
    expect = {v for v in vals if q1 - 3 * (q3 - q1) <= v <= q3 + 3 * (q3 - q1)}
    assert kept == expect and 400.0 not in kept and 1000.0 not in kept
    assert q3 + 1.5 * (q3 - q1) < 200.0 < q3 + 3 * (q3 - q1)  # factor 3, not 1.5


def test_approx_within_error(spark):
    df = spark.range(20000).select((F.col("id") * 1.0).alias("x"))
    row = Q.approx_quantile_row(df, ["x"], [0.25, 0.75], 0.01).first()
    assert abs(row["x"][0] - 5000) <= 0.01 * 20000 and abs(row["x"][1] - 15000) <= 0.01 * 20000


def test_exact_quantiles_extreme_range(spark):
    vals = [-1.7e308, 1.7e308, 0.0, 1.0, 2.0, 5e-324, -5e-324, 3.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.3, 0.5, 0.7, 1.0]
    got = Q.exact_quantiles(df, ["x"], probs, buckets=16)
    srt = sorted(vals)
    for p in probs:
        h = (len(vals) - 1) * p
        lo, hi = srt[int(h)], srt[min(int(h) + 1, len(vals) - 1)]
        want = lo if h == int(h) else lo + (hi - lo) * (h - int(h))
        assert got[("x", p)] == want


def test_approx_rank_error_vs_exact(spark, sf_small):
    """T11: approximate quartiles differ from exact ones but stay within rel_error * n in rank."""
    from joulebox.sources import testdata

    e = testdata.table(spark, sf_small, "lineitem").select(F.col("l_extendedprice").alias("x"))
    n = e.count()
    approx = Q.approx_quantile_row(e, ["x"], [0.25, 0.75], 0.01).first()["x"]
    exact = Q.exact_quantiles(e, ["x"], [0.25, 0.75])
    for v, p in zip(approx, (0.25, 0.75)):
        rank = e.filter(F.col("x") <= v).count()
        assert abs(rank - p * n) <= 0.01 * n + 1
        assert abs(v - exact[("x", p)]) / exact[("x", p)] < 0.05


def test_nan_and_infinities_are_no_values(spark):
    vals = [1.0, 2.0, 3.0, float("nan"), float("inf"), float("-inf"), None] + [2.0] * 50
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    finite = [v for v in vals if v is not None and np.isfinite(v)]
    got = Q.exact_quantiles(df, ["x"], [0.0, 0.01, 0.5, 1.0], buckets=4)
    assert [got[("x", p)] for p in (0.0, 0.01, 0.5, 1.0)] == [np_quantile(finite, p) for p in (0.0, 0.01, 0.5, 1.0)]
    assert Q.approx_quantile_row(df, ["x"], [1.0]).first()["x"] == [3.0]


def test_exact_quantiles_beyond_the_sketch(spark):
    vals = [float(i * i % 9973) + i / 1e6 for i in range(40_000)]  # more distinct values than the sketch keeps
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(6)
    probs = [0.001, 0.25, 0.4999, 0.9, 0.9999]
    got = Q.exact_quantiles(df, ["x"], probs)
    assert all(abs(got[("x", p)] - np_quantile(vals, p)) < 1e-9 for p in probs)
