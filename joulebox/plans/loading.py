"""Sinks and load strategies.

Paths may be local or any Hadoop file system; existence is tested explicitly
(never "any error means first run"). Named tables go through the session
catalog. Nothing here collects data to the driver.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulebox.operators.joins import new_keys
from joulebox.session import delete_path, stage_table, staging


# ---------------------------------------------------------------- paths

def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def runs_of(spark: SparkSession, folder: str, column: str) -> list[str]:
    """Values of ``column`` that have a folder of their own (``column=value``) in ``folder``."""
    fs, p = _fs_path(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return [n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}=")]


def without_rows(spark: SparkSession, path: str, column: str, values: list) -> None:
    """Remove the folders of partitions that have no rows any more."""
    for v in values:
        delete_path(spark, f"{path.rstrip('/')}/{column}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}")


def _clustered(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Rows of one partition value together, so a write makes few files per value and none per task and value.

    ``rebalance`` splits values with many rows and joins small ones to the session's advisory size.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    w = _clustered(df, partition_by).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


#: Rows of a compressed JSON file at most: one task reads such a file from its start to its end.
JSON_ROWS_PER_FILE = 500_000


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, compressed: they repeat the column names in every row. Readers know them by the ending ``.json.gz``."""
    df.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", JSON_ROWS_PER_FILE).json(path)


def append_if_rows(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> bool:
    """Append unless the frame is empty; its plan runs once (the emptiness test reads the staged rows)."""
    with staging(df.sparkSession):
        staged = stage_table(df, "append")
        if staged.isEmpty():
            return False
        w = _clustered(staged, partition_by).write.mode("append").format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(path)
    return True


def load_once(spark: SparkSession, df: DataFrame, path: str) -> bool:
    """Static dimension: write only when the target is missing or empty."""
    if path_exists(spark, path) and not spark.read.parquet(path).isEmpty():
        return False
    write_parquet(df, path)
    return True


def dim_append_new(spark: SparkSession, df: DataFrame, path: str, key: str) -> DataFrame:
    """SCD type 0: append rows whose key is not yet stored; first run writes all.

    Returns the rows that were (or would be) appended. The batch is deduped on
    the key first; existing keys are never updated.
    """
    batch = df.dropDuplicates([key])
    if not path_exists(spark, path):
        write_parquet(batch, path)
        return spark.read.parquet(path)
    fresh = new_keys(batch, spark.read.parquet(path), key)
    # materialise before appending: the anti-join reads the same path (and the rows are returned, so they outlive the job)
    staged = stage_table(fresh, "dim-new")
    if not staged.isEmpty():
        staged.write.mode("append").parquet(path)
    return staged


# ---------------------------------------------------------------- merge

def unique_keys(source: DataFrame, key: str) -> DataFrame:
    """The distinct non-NULL keys of a MERGE source; the job fails where a key occurs twice."""
    keys = source.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    message = F.concat(F.lit("MERGE source has more than one row for key "), F.col(key).cast("string"))
    return keys.filter(F.assert_true(F.col("_n") == 1, message).isNull()).select(key)


def merge_upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """MERGE ON key: matched -> source row, not matched -> insert, others kept.

    NULL keys never match, so target rows with a NULL key stay and source rows
    with a NULL key are inserted, as in SQL MERGE; two source rows with the same key are an
    error, as there. One shuffle join on the key; NULL keys stay out of it.
    """
    nulls = target.filter(F.col(key).isNull())
    kept = target.filter(F.col(key).isNotNull()).join(unique_keys(source, key), on=key, how="left_anti")
    return kept.select(*target.columns).unionByName(nulls).unionByName(source.select(*target.columns))


def merge_counts(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """One row: source rows that update an existing key and rows that insert (NULL keys insert)."""
    hits = target.select(key).distinct().withColumn("_hit", F.lit(True))
    tagged = source.select(key).join(hits, on=key, how="left")
    return tagged.agg(
        F.count_if(F.col("_hit").isNotNull()).alias("updated"), F.count_if(F.col("_hit").isNull()).alias("inserted")
    )


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _versioned(spark: SparkSession, table: str) -> str:
    """A new folder for a version of ``table``, beside its other ones in the warehouse."""
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{root}/{table.replace('.', '/')}__versions/{uuid.uuid4().hex[:12]}"


def _replaced(spark: SparkSession, table: str) -> str:
    """Where it is noted which versions of ``table`` were replaced, and when."""
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{root}/{table.replace('.', '/')}__replaced"


def swap_in(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Replace a table's rows in one step.

    The rows are written to a folder of their own, then the catalog's location of the table is
    switched to it (one call). Readers see the old version until then; a failure before
    leaves it as it was. The old version stays, for those that read it now, until ``vacuum`` removes it. Runs at the same time
    have folders of their own.
    """
    path = _versioned(spark, table)
    df.write.parquet(path)
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet")
        return
    note = spark.createDataFrame([(_location(spark, table),)], "version string").withColumn("replaced_at", F.current_timestamp())
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    note.coalesce(1).write.mode("append").parquet(_replaced(spark, table))


def vacuum(spark: SparkSession, table: str, retain_seconds: float = 7 * 86_400) -> list[str]:
    """Remove the versions that were replaced more than ``retain_seconds`` ago; returns them.

    Take more than the longest query runs: a frame planned before a swap reads its version until then. Folders
    of swaps that failed before the switch are older than that, too, when they go.
    """
    gone, current = [], _location(spark, table)
    notes = _replaced(spark, table)
    if path_exists(spark, notes):
        last = spark.read.parquet(notes).groupBy("version").agg(F.max("replaced_at").alias("at"))
        old = last.where(F.col("at") <= F.current_timestamp() - F.make_dt_interval(secs=F.lit(float(retain_seconds))))
        gone = [r["version"] for r in old.collect() if r["version"] != current and path_exists(spark, r["version"])]
        known = {r["version"] for r in last.collect()}
    else:
        known = set()
    fs, folder = _fs_path(spark, _versioned(spark, table).rsplit("/", 1)[0])
    if fs.exists(folder):
        now = spark.sql("SELECT unix_millis(current_timestamp())").first()[0]
        named = {v.rsplit("/", 1)[1] for v in [*known, current]}
        for s in fs.listStatus(folder):
            if s.getPath().getName() not in named and now - s.getModificationTime() >= retain_seconds * 1000:
                gone.append(s.getPath().toString())
    for path in gone:
        delete_path(spark, path)
    return gone


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """Overwriting replaces only the partitions that have new rows (a writer's option does not reach ``insertInto``)."""
    name = "spark.sql.sources.partitionOverwriteMode"
    was = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def merge_partitions(spark: SparkSession, source: DataFrame, table: str, key: str, part: str) -> list:
    """MERGE into a table partitioned by ``part``, rewriting the touched partitions only; returns them.

    Touched are the partitions of the source's rows and those that hold a target row with a source
    key (a row whose partition moved must leave its old one). Only the key and partition
    columns of the target are read to find them. The partition values (days) are few.
    """
    target = spark.table(table)
    with staging(spark):
        source = stage_table(source, "merge-source")
        if source.isEmpty():
            return []
        hit = target.select(key, part).join(unique_keys(source, key), on=key, how="left_semi").select(part)
        touched = sorted((r[0] for r in hit.union(source.select(part)).distinct().collect()), key=str)
        here = F.col(part).isin([v for v in touched if v is not None])
        here = here | F.col(part).isNull() if None in touched else here
        merged = stage_table(merge_upsert(target.filter(here), source, key), "merged")
        left = {r[0] for r in merged.select(part).distinct().collect()}
        ordered = merged.select(*[c for c in target.columns if c != part], part)
        with _dynamic_overwrite(spark):
            _clustered(ordered, [part]).write.insertInto(table, overwrite=True)
        for v in touched:
            if v not in left and v is not None:  # all of its rows have moved
                value = f"'{v}'" if isinstance(v, str) else f"DATE '{v}'" if hasattr(v, "year") else str(v)
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({part} = {value})")
    spark.catalog.refreshTable(table)
    return touched


#: Column by which a bucketed table is partitioned; its value is the bucket that Spark's own bucketing gives the key.
BUCKET = "key_bucket"


def bucket_of(key: str, buckets: int):
    return F.pmod(F.hash(F.col(key)), F.lit(buckets)).cast("int")


def create_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A table bucketed by ``key``, each bucket in a partition of its own, so that joins on the key need no shuffle of it
    and a bucket can be replaced by itself. Take at least as many buckets as the session has shuffle partitions."""
    own = df.withColumn(BUCKET, bucket_of(key, buckets)).repartition(buckets, F.col(key))
    own.write.partitionBy(BUCKET).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def buckets_of(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"]) if rows else 0


def merged_buckets(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows, replaced by the source's of the same key, and the source's other rows: one outer join, where the bucketed
    side is read bucket by bucket and only the source is shuffled."""
    names = [c for c in target.columns if c != key]
    new, old = source.select(F.col(key).alias("_key"), F.struct(*names).alias("_new")), target.select(key, F.struct(*names).alias("_old"))
    both = old.join(new.hint("merge"), F.col(key) == F.col("_key"), "full_outer")
    row = F.when(F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col("_old"))
    return both.select(F.coalesce(F.col(key), F.col("_key")).alias(key), row.alias("_row")).select(key, "_row.*").select(*target.columns)


def merge_buckets(spark: SparkSession, source: DataFrame, table: str, key: str) -> list[int]:
    """MERGE into a bucketed table: only the buckets of the source's keys are read and rewritten; returns them.

    A key's bucket never changes, so one overwrite of the touched buckets is the whole change. NULL keys never match:
    they are in one bucket, and are inserted as in SQL.
    """
    buckets = buckets_of(spark, table)
    with staging(spark):
        source = stage_table(source.withColumn(BUCKET, bucket_of(key, buckets)), "merge-source")
        unique_keys(source, key).count()  # an error where a key occurs twice
        touched = sorted(r[0] for r in source.select(BUCKET).distinct().collect())
        if not touched:
            return []
        target = spark.table(table)
        merged = merged_buckets(target.filter(F.col(BUCKET).isin(touched)), source, key)
        # a task has one bucket's rows; new files replace the buckets' old ones when all are written, so reading them meanwhile is safe
        with _dynamic_overwrite(spark):
            merged.select(*[c for c in target.columns if c != BUCKET], BUCKET).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    return touched


def merge_into_table(
    spark: SparkSession, source: DataFrame, table: str, key: str, row_level: bool = False, partition: str | None = None, buckets: int | None = None
) -> str:
    """Upsert ``source`` into a catalog table; returns 'created', 'merged' or 'skipped' (no source rows).

    First run creates the table. With ``row_level`` (a catalog that supports
    MERGE, e.g. Delta or Iceberg) the DataFrame ``mergeInto`` API is used. A table
    partitioned by ``partition`` has its touched partitions rewritten, one made with
    ``buckets`` its touched buckets; any other is rewritten as a new version and switched to.
    """
    if not spark.catalog.tableExists(table):
        if buckets:
            create_bucketed(source, table, key, buckets)
        elif partition:
            _clustered(source, [partition]).write.partitionBy(partition).saveAsTable(table)
        else:
            swap_in(spark, source, table)
        return "created"
    if row_level:
        (
            source.mergeInto(table, F.col(f"{table}.{key}") == source[key])
            .whenMatched()
            .updateAll()
            .whenNotMatched()
            .insertAll()
            .merge()
        )
        return "merged"
    if buckets:
        return "merged" if merge_buckets(spark, source, table, key) else "skipped"
    if partition:
        return "merged" if merge_partitions(spark, source, table, key, partition) else "skipped"
    if source.isEmpty():
        return "skipped"
    swap_in(spark, merge_upsert(spark.table(table), source, key), table)
    return "merged"


def replace_table(df: DataFrame, table: str, options: dict[str, str] | None = None, fmt: str | None = None) -> None:
    """Overwrite a catalog table; ``options`` and ``fmt`` go to the writer (e.g. for a warehouse connector)."""
    w = df.write.mode("overwrite").options(**(options or {}))
    (w.format(fmt) if fmt else w).saveAsTable(table)


def replace_unless_empty(df: DataFrame, table: str) -> bool:
    """Overwrite a table, but keep it as it is if there are no rows for it."""
    if df.isEmpty():
        return False
    replace_table(df, table)
    return True


def publish_tables(spark: SparkSession, datasets: dict[str, str], fmt: str = "json") -> list[str]:
    """Read each dataset path and replace the named table with it."""
    done = []
    for path, table in datasets.items():
        replace_table(spark.read.format(fmt).load(path), table)
        done.append(table)
    return done
