"""Queries for the model operators and the building-health table.

Health queries use a one-variable least-squares line fitted on a stable md5 split; the whole
energy model (six numbers, two one-hot categories) is checked against a solution in SQL, both as
the closed form and as MLlib's saved pipeline; the encoding stages are checked vector by vector.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from joulebox.operators.aggregates import flagged_share, regression_metrics
from joulebox.operators.cleaning import filter_not_equal
from joulebox.operators.topk import top_k
from joulebox.plans import model as M
from joulebox.queries import q_cleaning
from joulebox.queries import sql as S
from joulebox.registry import memo, register
from joulebox.schema import STATUS_NORMAL
from joulebox.session import stage_table


def processed(spark: SparkSession, sf: str):
    """The cleaned readings with features, checkpointed once per session.

    The model stage starts from stored processed data, as the original's model
    job re-reads the processed JSON: parquet written once under the shared
    checkpoint folder cuts the lineage, so every model query plans from a scan
    instead of re-deriving (and re-optimising) the whole cleaning plan.
    """
    return memo(spark, ("processed", sf), lambda: stage_table(q_cleaning.features(spark, sf), "processed"))


def model_base(spark: SparkSession, sf: str):
    return M.model_input(processed(spark, sf))


def split(spark: SparkSession, sf: str):
    return M.stable_split(model_base(spark, sf))


def predictions(spark: SparkSession, sf: str):
    """The line's predictions for the test rows, stored as the model job stores them."""
    return memo(spark, ("predictions", sf), lambda: stage_table(M.line_predictions(*split(spark, sf)), "predictions"))


def health(spark: SparkSession, sf: str):
    """building_health over the line's predictions with exact decile cuts, stored: the reports read this table."""
    return memo(spark, ("health", sf), lambda: stage_table(M.building_health(predictions(spark, sf), mode="exact"), "health"))


def ridge(spark: SparkSession, sf: str):
    """(the whole energy model in closed form, test rows)."""
    train, test = split(spark, sf)
    return memo(spark, ("ridge", sf), lambda: M.fit_ridge(train)), test


def encoder(spark: SparkSession, sf: str):
    """(fitted encoding stages, test rows)."""
    from pyspark.ml import Pipeline

    train, test = split(spark, sf)
    return memo(spark, ("encoder", sf), lambda: Pipeline(stages=M.encoding_stages()).fit(train)), test


#: Indexes of the categories of a table: by falling frequency, then name.
def ranks(table: str) -> str:
    one = """{c}_rank AS (SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i, count(*) OVER () AS n FROM {t} GROUP BY {c})"""
    return ", ".join(one.format(c=c, t=table) for c in M.CATEGORIES)


def hot(c: str) -> str:
    """A category's one-hot vector as text: n places, the last index ('keep') has none."""
    r = f"{c}_rank"
    return f"repeat('0,', CAST({r}.i AS INTEGER)) || '1' || repeat(',0', CAST({r}.n - 1 - {r}.i AS INTEGER))"


BY_RANK = "JOIN BuildingType_rank USING (BuildingType) JOIN HVACSystem_rank USING (HVACSystem)"


def vector_text(col):
    """A vector of zeros and ones as text."""
    return F.array_join(F.transform(col, lambda x: x.cast("int").cast("string")), ",")


@register(
    "ml_index",
    S.with_features(
        f"""SELECT BuildingType, 'no such system' AS HVACSystem, CAST(i AS DOUBLE) AS BuildingType_index,
       CAST((SELECT max(n) FROM HVACSystem_rank) AS DOUBLE) AS HVACSystem_index FROM BuildingType_rank
UNION ALL SELECT NULL, HVACSystem, CAST((SELECT max(n) FROM BuildingType_rank) AS DOUBLE), CAST(i AS DOUBLE) FROM HVACSystem_rank"""
    ).replace("\nSELECT BuildingType, 'no such", f", {ranks('features')}\nSELECT BuildingType, 'no such"),
)
def q_ml_index(spark, sf):
    """Indexes of all types (with an unseen system) and of all systems (with a NULL type)."""
    feats = processed(spark, sf)
    probes = feats.select("BuildingType", F.lit("no such system").alias("HVACSystem")).distinct()
    probes = probes.union(feats.select(F.lit(None).cast("string").alias("BuildingType"), "HVACSystem").distinct())
    return M.category_indexer().fit(feats).transform(probes)


@register("ml_index__dictionary", S.with_features(
    """SELECT EnergyPerArea, CAST(i AS DOUBLE) AS EnergyPerArea_index FROM features JOIN (
  SELECT EnergyPerArea, row_number() OVER (ORDER BY count(*) DESC, EnergyPerArea) - 1 AS i FROM features
  WHERE EnergyPerArea IS NOT NULL GROUP BY EnergyPerArea) USING (EnergyPerArea)"""
))
def q_ml_index_dictionary(spark, sf):
    """Indexes of a column of nearly as many values as rows, which no driver need hold."""
    rows = processed(spark, sf).select("EnergyPerArea").where("EnergyPerArea is not null")
    return M.index_by(rows, M.category_dictionary(rows, "EnergyPerArea"), "EnergyPerArea", "EnergyPerArea_index")


@register(
    "ml_onehot",
    S.with_model(
        f"""SELECT BuildingType, HVACSystem, {hot('BuildingType')} AS type_hot, {hot('HVACSystem')} AS system_hot, count(*) AS rows
FROM test {BY_RANK} GROUP BY ALL"""
    ).replace("\nSELECT BuildingType, HVACSystem, repeat", f", {ranks('train')}\nSELECT BuildingType, HVACSystem, repeat"),
)
def q_ml_onehot(spark, sf):
    from pyspark.ml.functions import vector_to_array

    model, test = encoder(spark, sf)
    hot_text = lambda c: vector_text(vector_to_array(f"{c}_ohe"))
    coded = model.transform(test).select("BuildingType", "HVACSystem", hot_text("BuildingType").alias("type_hot"), hot_text("HVACSystem").alias("system_hot"))
    return coded.groupBy(*coded.columns).agg(F.count(F.lit(1)).alias("rows"))


@register(
    "ml_assemble_etl",
    S.with_features(
        f"""SELECT AverageTemperature AS f0, OutsideTemperature AS f1, InsulationThickness AS f2, CAST(NumberofAppliances AS DOUBLE) AS f3,
       RoomArea AS f4, CAST(BuildingType_rank.i AS DOUBLE) AS f5, CAST(HVACSystem_rank.i AS DOUBLE) AS f6, EnergyConsumption
FROM features {BY_RANK}"""
    ).replace("\nSELECT AverageTemperature AS f0", f", {ranks('features')}\nSELECT AverageTemperature AS f0"),
)
def q_ml_assemble_etl(spark, sf):
    from pyspark.ml.functions import vector_to_array

    v = vector_to_array("features")
    table = M.ml_feature_table(processed(spark, sf))
    return table.select(*[F.get(v, F.lit(i)).alias(f"f{i}") for i in range(len(M.ASSEMBLED) + len(M.CATEGORIES))], M.LABEL)


@register(
    "ml_assemble_model",
    S.with_model(
        f"""SELECT AverageTemperature AS f0, OutsideTemperature AS f1, InsulationThickness AS f2, CAST(NumberofAppliances AS DOUBLE) AS f3,
       RoomArea AS f4, TemperatureDifference AS f5, {hot('BuildingType')} || ',' || {hot('HVACSystem')} AS hot, EnergyConsumption
FROM test {BY_RANK}"""
    ).replace("\nSELECT AverageTemperature AS f0", f", {ranks('train')}\nSELECT AverageTemperature AS f0"),
)
def q_ml_assemble_model(spark, sf):
    from pyspark.ml.functions import vector_to_array

    model, test = encoder(spark, sf)
    n = len(M.ASSEMBLED) + 1
    v = model.transform(test).select(vector_to_array("features").alias("v"), M.LABEL)
    return v.select(*[F.get("v", F.lit(i)).alias(f"f{i}") for i in range(n)], vector_text(F.slice("v", n + 1, F.size("v"))).alias("hot"), M.LABEL)


@register(
    "ml_split",
    S.with_model("SELECT is_train, count(*) AS rows FROM keyed GROUP BY is_train"),
)
def q_ml_split(spark, sf):
    return model_base(spark, sf).groupBy(M.train_flag().alias("is_train")).agg(F.count(F.lit(1)).alias("rows"))


# The ridge of all inputs, solved in SQL. A training row is its six numbers (less their means), a one for its type and one for its system. Inputs
# and label are scaled to unit (population) deviation, the penalty of 0.1 is divided by the label's, and the normal
# equations (positive definite, so without pivoting) are solved by Gauss-Jordan elimination, a column each step.
RIDGE = f"""mu AS ({" UNION ALL ".join(f"SELECT '{c}' AS term, avg({c}) AS mu FROM train" for c in M.NUMBERS)}),
x AS (
  SELECT row_number() OVER () AS id, EnergyConsumption AS y, {", ".join(f"{c} - avg({c}) OVER () AS n{i}" for i, c in enumerate(M.NUMBERS))},
         {", ".join(f"'{c}=' || {c} AS t{i}" for i, c in enumerate(M.CATEGORIES))} FROM train),
w AS ({" UNION ALL ".join([f"SELECT id, '{c}' AS term, n{i} AS v FROM x" for i, c in enumerate(M.NUMBERS)] + [f"SELECT id, t{i}, 1.0 FROM x" for i in range(len(M.CATEGORIES))])}),
y AS (SELECT avg(y) AS my, stddev_pop(y) AS sy, count(*) AS n FROM x),
p AS (SELECT a.term AS a, b.term AS b, sum(a.v * b.v) AS s FROM w a JOIN w b USING (id) GROUP BY ALL),
f AS (SELECT term, row_number() OVER (ORDER BY term) AS i, m, sd, r FROM (
  SELECT term, sum(v) / any_value(n) AS m, sqrt(any_value(p.s) / any_value(n) - (sum(v) / any_value(n)) ** 2) AS sd,
         sum(v * (x.y - my)) / any_value(n) AS r
  FROM w JOIN x USING (id) JOIN p ON p.a = term AND p.b = term, y GROUP BY term) WHERE sd > 0),
g AS (SELECT a.i, list((coalesce(p.s, 0) / n - a.m * b.m) / (a.sd * b.sd) + CASE WHEN a.i = b.i THEN 0.1 / sy ELSE 0 END ORDER BY b.i) || [any_value(a.r / (a.sd * sy))] AS row
      FROM f a CROSS JOIN f b CROSS JOIN y LEFT JOIN p ON p.a = a.term AND p.b = b.term GROUP BY a.i),
e(k, m) AS (
  SELECT 1, list(row ORDER BY i) FROM g
  UNION ALL
  SELECT k + 1, list_transform(m, lambda u, i: CASE WHEN i = k THEN list_transform(u, lambda c: c / m[k][k])
                                               ELSE list_transform(u, lambda c, j: c - u[k] / m[k][k] * m[k][j]) END)
  FROM e WHERE k <= len(m)),
b AS (SELECT term, f.m AS mean, u.m[i][len(u.m) + 1] * sy / sd AS b FROM f, y, (SELECT m FROM e ORDER BY k DESC LIMIT 1) u),
ridge AS (SELECT term, b FROM b UNION ALL SELECT 'intercept', any_value(my) - sum(b * (mean + coalesce(mu, 0))) FROM b LEFT JOIN mu USING (term), y),
scored AS (SELECT test.*, {" + ".join(f"(SELECT b FROM ridge WHERE term = '{c}') * {c}" for c in M.NUMBERS)}
             + coalesce(t.b, 0) + coalesce(h.b, 0) + (SELECT b FROM ridge WHERE term = 'intercept') AS guess
           FROM test LEFT JOIN ridge t ON t.term = 'BuildingType=' || BuildingType LEFT JOIN ridge h ON h.term = 'HVACSystem=' || HVACSystem)
"""


def with_ridge(select: str) -> str:
    return S.with_model("SELECT 0").replace("WITH ", "WITH RECURSIVE ", 1).replace("\nSELECT 0", f", {RIDGE}{select}")


RIDGE_ROWS = with_ridge(
    """SELECT EnergyConsumption, round(guess, 2) AS prediction, BuildingType, HVACSystem, RoomArea, NumberofAppliances,
       InsulationThickness, EnergyPerArea FROM scored"""
)


def rounded(predicted):
    return predicted.withColumn("prediction", F.round("prediction", 2))


@register("ml_linear_regression", with_ridge("SELECT term, round(b, 1) AS coefficient, CAST(0 AS DOUBLE) AS gradient FROM ridge"))
def q_ml_linear_regression(spark, sf):
    """Every coefficient of the whole model (six numbers, all types and systems, the intercept), and the gradient of the
    penalised loss there, which is 0.

    The one-hot columns of a category add up to a constant, so what all of its effects share is held by the small
    penalty alone: solvers agree on it to about four decimals.
    """
    model, _ = ridge(spark, sf)
    train, _ = split(spark, sf)
    gradient = dict(M.optimality(model, train))
    rows = [(t, b, gradient[t]) for t, b in model.terms()]
    return spark.createDataFrame(rows, "term string, b double, g double").select(
        "term", F.round("b", 1).alias("coefficient"), (F.round("g", 6) + 0.0).alias("gradient")
    )


@register("ml_predict", RIDGE_ROWS)
def q_ml_predict(spark, sf):
    model, test = ridge(spark, sf)
    return rounded(model.predictions(test))


@register(
    "ml_evaluate",
    with_ridge(
        """SELECT round(sqrt(avg((EnergyConsumption - guess) * (EnergyConsumption - guess))), 4) AS rmse,
       round(avg(abs(EnergyConsumption - guess)), 4) AS mae,
       round(1 - sum((EnergyConsumption - guess) * (EnergyConsumption - guess)) / (var_pop(EnergyConsumption) * count(*)), 6) AS r2
FROM scored"""
    ),
)
def q_ml_evaluate(spark, sf):
    model, test = ridge(spark, sf)
    got = regression_metrics(model.predictions(test), "EnergyConsumption", "prediction")
    return got.select(F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


@register(
    "regression_metrics",
    S.with_model(
        """SELECT sqrt(avg((EnergyConsumption - prediction) * (EnergyConsumption - prediction))) AS rmse,
       avg(abs(EnergyConsumption - prediction)) AS mae,
       1 - sum((EnergyConsumption - prediction) * (EnergyConsumption - prediction))
           / (var_pop(EnergyConsumption) * count(EnergyConsumption)) AS r2
FROM pred"""
    ),
)
def q_regression_metrics(spark, sf):
    return regression_metrics(predictions(spark, sf), "EnergyConsumption", "prediction")


@register("building_health", S.with_model("SELECT * FROM health"))
def q_building_health(spark, sf):
    return health(spark, sf)


@register(
    "filter_not_equal", S.with_model("SELECT * FROM health WHERE EfficiencyStatus <> 'Normal Range'")
)
def q_filter_not_equal(spark, sf):
    return filter_not_equal(health(spark, sf), "EfficiencyStatus", STATUS_NORMAL)


@register(
    "flagged_share",
    S.with_model(
        """SELECT count(*) FILTER (WHERE EfficiencyStatus <> 'Normal Range') AS FlaggedRecords, count(*) AS TotalRecords,
       CAST(count(*) FILTER (WHERE EfficiencyStatus <> 'Normal Range') AS DOUBLE) / count(*) AS FlaggedShare
FROM health"""
    ),
)
def q_flagged_share(spark, sf):
    return flagged_share(health(spark, sf))


@register(
    "topk_deviation",
    S.with_model(
        """SELECT * FROM health ORDER BY DeviationPercent DESC NULLS LAST, BuildingType, HVACSystem, RoomArea,
         NumberofAppliances, InsulationThickness, EnergyPerArea, ActualEnergy, ExpectedEnergy, EfficiencyStatus LIMIT 10"""
    ),
)
def q_topk_deviation(spark, sf):
    h = health(spark, sf)
    return top_k(h, [F.col("DeviationPercent").desc_nulls_last()], 10, [c for c in h.columns if c != "DeviationPercent"])


@register("sink_model", RIDGE_ROWS)
def q_sink_model(spark, sf):
    """Save MLlib's pipeline of the whole model over an older one, load it back, score the test rows."""
    from joulebox.queries.q_star import fresh

    train, test = split(spark, sf)
    path = fresh(spark, "model")
    M.save_model(M.fit_numeric_model(train, ["RoomArea"]), path)
    M.save_model(M.fit_energy_model(train), path)  # replaces the other model
    return rounded(M.predictions(M.load_model(path), test))


def raised(error, work) -> bool:
    try:
        work()
    except error:
        return True
    return False


@register(
    "require_columns",
    S.with_features(
        "SELECT AverageTemperature, OutsideTemperature, InsulationThickness, NumberofAppliances, RoomArea, "
        "TemperatureDifference, BuildingType, HVACSystem, EnergyConsumption, EnergyPerArea, TRUE AS lack_is_an_error FROM features"
    ),
)
def q_require_columns(spark, sf):
    from joulebox.operators.cleaning import MissingColumnsError, require_columns
    from joulebox.schema import ML_REQUIRED_COLUMNS

    table = processed(spark, sf)
    lacks = all(raised(MissingColumnsError, lambda: require_columns(table.drop(c), ML_REQUIRED_COLUMNS)) for c in ML_REQUIRED_COLUMNS)  # noqa: B023
    return require_columns(table, ML_REQUIRED_COLUMNS).select(*ML_REQUIRED_COLUMNS, F.lit(lacks).alias("lack_is_an_error"))


@register("fail_if_empty", S.with_features("SELECT *, TRUE AS empty_is_an_error FROM features"))
def q_fail_if_empty(spark, sf):
    from joulebox.operators.cleaning import EmptyResultError, fail_if_empty

    table = processed(spark, sf)
    empty = raised(EmptyResultError, lambda: fail_if_empty(table.filter(F.col("RoomArea") < 0), "no such rooms"))
    return fail_if_empty(table, "no readings left").withColumn("empty_is_an_error", F.lit(empty))
