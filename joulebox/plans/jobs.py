"""Batch jobs: read -> library functions -> write. Each returns a small summary dict.

First pipeline:  ``etl_job`` (raw JSON -> processed readings, aggregates,
ML feature table), ``model_job`` (processed -> predictions, health, model),
``publish_job`` (datasets -> catalog tables).
Reports:         ``report`` (one dashboard query over the published tables).
Medallion:       ``extract_job`` (raw batch -> bronze), ``transform_job``
(new bronze files -> silver, dims, the run's fact rows), ``load_job`` (gold -> catalog
tables with MERGE of the fact rows of all runs not loaded yet).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulebox.operators.cleaning import fail_if_empty
from joulebox.plans import ledger as ledgers
from joulebox.plans import loading as L
from joulebox.plans import medallion as G
from joulebox.plans import model as M
from joulebox.plans import readings as R
from joulebox.plans import reports as P
from joulebox.schema import RAW_READING_LOOSE
from joulebox.session import stage_table, staging
from joulebox.sources.files import has_rows, read_json_inferred, read_json_schema, split_corrupt


def _write(df, path: str, fmt: str) -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def etl_job(
    spark: SparkSession, raw_path: str, out_base: str, iqr_mode: str = "approx", fmt: str = "json", declared: bool = False
) -> dict:
    """``fmt`` is the format of the processed and analytics layers: JSON as the
    original wrote them, or parquet (columnar, pushdown) for large volumes.
    ``declared`` reads the raw JSON by its declared schema instead of inferring one
    (which costs a pass over the files)."""
    with staging(spark):
        raw = read_json_schema(spark, raw_path, RAW_READING_LOOSE) if declared else read_json_inferred(spark, raw_path)
        clean, report_df = R.clean_with_report(raw, iqr_mode=iqr_mode)
        feats = R.add_features(clean)
        fail_if_empty(feats, f"cleaning left none of the readings in {raw_path}")
        processed = f"{out_base}/processed/energy"
        _write(feats, processed, fmt)
        feats = spark.read.format(fmt).load(processed)  # later steps read the stored rows, not the cleaning plan
        _write(R.statistics(feats), f"{out_base}/analytics/energy_statistics", fmt)
        _write(R.by_building(feats), f"{out_base}/analytics/energy_by_building", fmt)
        _write(R.by_hvac(feats), f"{out_base}/analytics/energy_by_hvac", fmt)
        L.write_parquet(M.ml_feature_table(feats), f"{out_base}/analytics/ml_features")
        return report_df.first().asDict()


def model_job(
    spark: SparkSession,
    processed_path: str,
    out_base: str,
    split: str = "stable",
    health_mode: str = "approx",
    fmt: str = "json",
) -> dict:
    base = M.model_input(spark.read.format(fmt).load(processed_path))
    fail_if_empty(base, f"no reading in {processed_path} is complete enough for the model")
    train, test = M.stable_split(base) if split == "stable" else M.random_split(base)
    fail_if_empty(test, f"the test split of {processed_path} has no readings")
    model = M.fit_energy_model(train)
    pred = M.predictions(model, test)
    _write(pred, f"{out_base}/analytics/ml_predictions", fmt)
    pred = spark.read.format(fmt).load(f"{out_base}/analytics/ml_predictions")
    health = M.building_health(pred, mode=health_mode)
    _write(health, f"{out_base}/analytics/building_health", fmt)
    M.save_model(model, f"{out_base}/models/energy_linear_regression")
    out = M.evaluate(pred)
    share = (
        spark.read.format(fmt).load(f"{out_base}/analytics/building_health")
        .agg(F.count_if(F.col("EfficiencyStatus") != "Normal Range").alias("flagged"), F.count(F.lit(1)).alias("total"))
        .first()
    )
    out.update(flagged=share["flagged"], total=share["total"])
    return out


def publish_job(spark: SparkSession, out_base: str, prefix: str = "", fmt: str = "json") -> list[str]:
    datasets = {
        f"{out_base}/processed/energy": f"{prefix}processed_energy",
        f"{out_base}/analytics/energy_by_building": f"{prefix}energy_by_building",
        f"{out_base}/analytics/energy_by_hvac": f"{prefix}energy_by_hvac",
        f"{out_base}/analytics/energy_statistics": f"{prefix}energy_statistics",
        f"{out_base}/analytics/building_health": f"{prefix}building_health",
        f"{out_base}/analytics/ml_predictions": f"{prefix}ml_predictions",
    }
    return L.publish_tables(spark, datasets, fmt=fmt)


#: Column that the jobs add to tell the output of their runs apart.
RUN_ID = "run_id"
#: The run of a transform without a ledger, which takes all of bronze each time.
WHOLE = "all"


def extract_job(spark: SparkSession, batch_path: str, bronze_path: str, quarantine_path: str | None = None, ledger_path: str | None = None) -> dict:
    """Raw files -> bronze: those of the folder that no run has taken, by the ledger (beside bronze unless named).

    Each run has a folder of its own, which a run that is done over replaces, so a file's rows
    are in bronze once, whenever it arrived; bronze keeps them when the file goes.
    """
    ledger = ledger_path or f"{bronze_path.rstrip('/')}__extracted"
    run = ledgers.claim(spark, batch_path, ledger)
    if run is None:
        return {"written": False}
    good, bad = split_corrupt(ledgers.read_run(spark, run, batch_path, "json", G.raw_schema(), **G.RAW_OPTIONS))
    with staging(spark):
        staged = stage_table(good, "extract")
        wrote = not staged.isEmpty()
        if wrote:
            L.write_parquet(staged, f"{bronze_path}/{RUN_ID}={run.run_id}")
        if quarantine_path:
            L.write_json(bad, f"{quarantine_path}/{RUN_ID}={run.run_id}")
    ledgers.finish(spark, ledger, run.run_id)
    return {"written": wrote}


def transform_job(
    spark: SparkSession, bronze_path: str, lake: str, ledger_path: str | None = None, partition_by: list[str] | None = None
) -> dict:
    """Silver, dims (calendar once, SCD0 category dims) and the run's fact rows.

    With a ledger only bronze files that no run has taken are read (or those of a run that
    broke off, again): rows that arrive late for a batch are new files like any other. A run's silver
    and fact rows have folders of their own, which are overwritten, so a run that is done over replaces its output, and a
    run without rows leaves what earlier runs wrote. Without a ledger all of bronze is one
    run. ``partition_by`` (e.g. ``["date_key"]``) partitions the silver and fact files so date filters prune.
    """
    run_id = WHOLE
    if ledger_path:
        run = ledgers.claim(spark, bronze_path, ledger_path)
        if run is None:
            return {"silver_rows": 0}
        run_id, bronze = run.run_id, ledgers.read_run(spark, run, bronze_path)
    else:
        bronze = spark.read.parquet(bronze_path)
    with staging(spark):
        silver = stage_table(G.to_silver(bronze.drop(RUN_ID)), "silver")  # one computation feeds silver, dims and fact
        rows = silver.count()
        if rows:
            L.write_parquet(silver, f"{lake}/silver/power_consumption/{RUN_ID}={run_id}", partition_by=partition_by)
            L.write_parquet(G.fact_energy(silver), f"{lake}/gold/fact_energy_consumption/{RUN_ID}={run_id}", partition_by=partition_by)
        L.load_once(spark, G.calendar(spark), f"{lake}/gold/dim_date")
        L.dim_append_new(spark, G.dim_building_type(silver), f"{lake}/gold/dim_building_type", "building_type_key")
        L.dim_append_new(spark, G.dim_hvac_system(silver), f"{lake}/gold/dim_hvac_system", "hvac_key")
    if ledger_path:
        ledgers.finish(spark, ledger_path, run_id)
    return {"silver_rows": rows}


def load_job(spark: SparkSession, lake: str, prefix: str = "") -> dict:
    """Gold -> catalog tables; the dimensions stay as they are where gold has no rows for them.

    The fact rows of every run that has not been loaded are merged, run by run in the order of their
    claims, so a later run's row of a key replaces an earlier one's; then the run is marked. A load that broke off merges a
    run again, which changes nothing.
    """
    gold = f"{lake}/gold"
    if not has_rows(spark, f"{prefix}dim_date"):
        L.replace_table(spark.read.parquet(f"{gold}/dim_date"), f"{prefix}dim_date")
    L.replace_unless_empty(spark.read.parquet(f"{gold}/dim_building_type"), f"{prefix}dim_building_type")
    L.replace_unless_empty(spark.read.parquet(f"{gold}/dim_hvac_system"), f"{prefix}dim_hvac_system")
    facts, loaded = f"{gold}/fact_energy_consumption", f"{gold}/loaded/{prefix or 'default'}"
    todo = sorted(set(L.runs_of(spark, facts, RUN_ID)) - ledgers.finished(spark, loaded))
    done = []
    for run_id in todo:
        rows = spark.read.parquet(f"{facts}/{RUN_ID}={run_id}")
        done.append(L.merge_into_table(spark, rows, f"{prefix}fact_energy_consumption", "RecordID", partition="date_key"))
        if run_id != WHOLE:
            ledgers.finish(spark, loaded, run_id)
    return {"fact": next((how for how in ("created", "merged") if how in done), "skipped"), "runs": len(done)}


REPORTS = ("filters", "kpis", "energy_by_type", "energy_by_hvac", "stats", "health_distribution", "health_share", "energy_vs_area", "epa_by_type", "predictions", "accuracy", "top_types", "alerts")


def report(spark: SparkSession, name: str, prefix: str = "", building_type: str | None = None, hvac_system: str | None = None) -> DataFrame:
    """One report from the six published tables, with the two optional filters."""
    table = lambda t: spark.table(f"{prefix}{t}")
    f = {"building_type": building_type, "hvac_system": hvac_system}
    makers = {
        "filters": lambda: P.filters(table("processed_energy")),
        "kpis": lambda: P.kpis(table("processed_energy"), table("building_health"), **f),
        "energy_by_type": lambda: P.energy_by_type(table("processed_energy"), table("energy_by_building"), **f),
        "energy_by_hvac": lambda: P.energy_by_hvac(table("processed_energy"), table("energy_by_hvac"), **f),
        "stats": lambda: P.stats_summary(table("energy_statistics")),
        "health_distribution": lambda: P.health_distribution(table("building_health"), **f),
        "health_share": lambda: P.health_share(table("building_health"), **f),
        "energy_vs_area": lambda: P.energy_vs_area(table("processed_energy"), **f),
        "epa_by_type": lambda: P.epa_by_type(table("processed_energy"), **f),
        "predictions": lambda: P.prediction_series(table("ml_predictions"), **f),
        "accuracy": lambda: P.prediction_accuracy(table("ml_predictions"), **f),
        "top_types": lambda: P.top_types(table("processed_energy"), table("building_health"), **f),
        "alerts": lambda: P.alerts(table("building_health"), **f),
    }
    if name not in makers:
        raise ValueError(f"no report {name!r}; there are {', '.join(REPORTS)}")
    return makers[name]()
