"""Command line: python -m joulebox <job> [args]

  etl       RAW_JSON OUT_BASE [approx|exact] [json|parquet]
  model     PROCESSED_JSON OUT_BASE [stable|random] [approx|exact] [json|parquet]
  publish   OUT_BASE [TABLE_PREFIX] [json|parquet]
  report    NAME [TABLE_PREFIX] [BUILDING_TYPE] [HVAC_SYSTEM]   (over the published tables; prints JSON rows)
  extract   BATCH_JSON BRONZE [QUARANTINE]
  transform BRONZE LAKE [LEDGER]
  load      LAKE
  ingest    LANDING TARGET CHECKPOINT     (availableNow file stream of raw readings)

The session comes from spark-submit / the environment; the checkpoint folder
is the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import SparkSession


def main(argv: list[str]) -> int:
    if not argv:
        print(__doc__)
        return 2
    from joulebox.plans import jobs
    from joulebox.session import ensure_checkpoint_dir

    spark = SparkSession.builder.appName(f"joulebox-{argv[0]}").getOrCreate()
    ensure_checkpoint_dir(spark)
    job, args = argv[0], argv[1:]
    if job == "etl":
        out = jobs.etl_job(spark, *args)
    elif job == "model":
        out = jobs.model_job(spark, *args)
    elif job == "publish":
        out = jobs.publish_job(spark, *args)
    elif job == "report":
        out = [json.loads(r) for r in jobs.report(spark, *args).toJSON().collect()]  # a report has few rows
    elif job == "extract":
        out = jobs.extract_job(spark, *args)
    elif job == "transform":
        out = jobs.transform_job(spark, *args)
    elif job == "load":
        out = jobs.load_job(spark, *args)
    elif job == "ingest":
        from joulebox.schema import RAW_READING
        from joulebox.streaming.ingest import ingest_files

        ingest_files(spark, args[0], RAW_READING, args[1], args[2])
        out = {"ingested": args[1]}
    else:
        print(__doc__)
        return 2
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
