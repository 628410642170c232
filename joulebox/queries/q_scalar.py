"""Queries for the scalar functions (one Catalyst expression each)."""

from __future__ import annotations

from pyspark.sql import functions as F

from joulebox import functions as J
from joulebox.functions.numeric import safe_divide
from joulebox.queries import sql as S
from joulebox.registry import register
from joulebox.sources import testdata

DEV = "round(value - 50, 2)"


@register(
    "fn_format_record_id",
    "SELECT l_orderkey, l_linenumber, printf('REC-%06d', l_orderkey) AS record_id, "
    "printf('POWER-BATCH-%04d', l_linenumber) AS batch_id FROM lineitem",
)
def q_fn_format_record_id(spark, sf):
    li = testdata.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", J.record_id("l_orderkey").alias("record_id"), J.batch_id("l_linenumber").alias("batch_id"))


@register(
    "fn_round_half_up",
    f"""SELECT l_orderkey, l_linenumber, {S.rnd('l_extendedprice / l_quantity', 2)} AS unit_price_2,
       {S.rnd('l_extendedprice / l_quantity', 4)} AS unit_price_4 FROM lineitem""",
)
def q_fn_round_half_up(spark, sf):
    li = testdata.table(spark, sf, "lineitem")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return li.select("l_orderkey", "l_linenumber", F.round(unit, 2).alias("unit_price_2"), F.round(unit, 4).alias("unit_price_4"))


@register(
    "fn_abs",
    "SELECT event_id, abs(value - 50) AS abs_dev FROM events",
)
def q_fn_abs(spark, sf):
    return testdata.events(spark, sf).select("event_id", F.abs(F.col("value") - 50).alias("abs_dev"))


@register(
    "fn_sqrt_pow",
    "SELECT event_id, sqrt(power(value - 50, 2) + 1) AS dist FROM events",
)
def q_fn_sqrt_pow(spark, sf):
    return testdata.events(spark, sf).select("event_id", F.sqrt(F.pow(F.col("value") - 50, 2) + 1).alias("dist"))


@register(
    "fn_greatest_least",
    f"SELECT event_id, {S.clamp_score('(value - 50)')} AS score FROM events",
)
def q_fn_greatest_least(spark, sf):
    return testdata.events(spark, sf).select("event_id", J.clamp_health_score(F.col("value") - 50).alias("score"))


@register(
    "fn_case",
    """SELECT event_id, CASE WHEN abs(value - 50) > 50 THEN 'critical' WHEN abs(value - 50) > 20 THEN 'warning'
       ELSE 'info' END AS severity FROM events""",
)
def q_fn_case(spark, sf):
    a = F.abs(F.col("value") - 50)
    sev = F.when(a > 50, "critical").when(a > 20, "warning").otherwise("info")
    return testdata.events(spark, sf).select("event_id", sev.alias("severity"))


@register(
    "fn_safe_divide",
    "SELECT l_orderkey, l_linenumber, l_extendedprice / CASE WHEN l_discount <> 0 THEN l_discount END AS per_discount FROM lineitem",
)
def q_fn_safe_divide(spark, sf):
    li = testdata.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", safe_divide("l_extendedprice", "l_discount").alias("per_discount"))


@register(
    "fn_isnan",
    f"""WITH {S.RAW.strip()}
SELECT count(*) FILTER (WHERE isnan(EnergyConsumption)) AS nan_rows,
       count(*) FILTER (WHERE NOT isnan(EnergyConsumption)) AS number_rows FROM raw""",
)
def q_fn_isnan(spark, sf):
    e = F.col("EnergyConsumption")
    return testdata.raw_readings(spark, sf).agg(F.count_if(F.isnan(e)).alias("nan_rows"), F.count_if(~F.isnan(e)).alias("number_rows"))


@register(
    "fn_to_date",
    f"""WITH {S.RAW.strip()}
SELECT RecordID, try_cast(ReadingDate AS DATE) AS reading_date, try_cast('2024-13-40' AS DATE) AS bad_date FROM raw""",
)
def q_fn_to_date(spark, sf):
    return testdata.raw_readings(spark, sf).select(
        "RecordID", J.parse_date("ReadingDate").alias("reading_date"), J.parse_date(F.lit("2024-13-40")).alias("bad_date")
    )


@register(
    "fn_date_key",
    f"""WITH {S.RAW.strip()}
SELECT RecordID, CAST(strftime(CAST(ReadingDate AS DATE), '%Y%m%d') AS INTEGER) AS date_key FROM raw""",
)
def q_fn_date_key(spark, sf):
    return testdata.raw_readings(spark, sf).select("RecordID", J.date_key(J.parse_date("ReadingDate")).alias("date_key"))


@register(
    "fn_date_parts",
    f"""WITH {S.RAW.strip()}
SELECT DISTINCT {S.DATE_PARTS}
FROM (SELECT CAST(ReadingDate AS DATE) AS d FROM raw)""",
)
def q_fn_date_parts(spark, sf):
    raw = testdata.raw_readings(spark, sf)
    return raw.select(J.parse_date("ReadingDate").alias("d")).distinct().select(*J.date_parts("d"))


@register(
    "fn_coalesce_zero",
    S.with_model(
        f"""SELECT BuildingType, RoomArea, coalesce(sum(CASE WHEN HVACSystem = 'VRF' THEN ActualEnergy END), 0) AS vrf_energy,
       CASE WHEN avg({S.clamp_score()}) IS NULL OR avg({S.clamp_score()}) = 0 THEN 75.0 ELSE avg({S.clamp_score()}) END AS score
FROM health GROUP BY BuildingType, RoomArea"""
    ),
)
def q_fn_coalesce_zero(spark, sf):
    """A missing sum is 0, and a score of 0 (or none) is the default of 75."""
    from joulebox.queries.q_model import health

    score = F.avg(J.clamp_health_score("DeviationPercent"))
    return health(spark, sf).groupBy("BuildingType", "RoomArea").agg(
        F.coalesce(F.sum(F.when(F.col("HVACSystem") == "VRF", F.col("ActualEnergy"))), F.lit(0.0)).alias("vrf_energy"),
        F.when(score.isNull() | (score == 0), F.lit(75.0)).otherwise(score).alias("score"),
    )


@register(
    "fn_message",
    f"""SELECT event_id, printf('Energy consumption is %.1f%% %s than predicted', {S.rnd(f'abs({DEV})', 1)},
       CASE WHEN {DEV} > 0 THEN 'higher' ELSE 'lower' END) AS message FROM events""",
)
def q_fn_message(spark, sf):
    return testdata.events(spark, sf).select("event_id", J.deviation_message(F.round(F.col("value") - 50, 2)).alias("message"))
