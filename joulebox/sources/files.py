"""File and catalog readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joulebox.session import stage_table_observed

CORRUPT_COLUMN = "_corrupt_record"


def read_json_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """JSON lines or one-line top-level arrays, types inferred.

    ``samplingRatio`` bounds the inference pass on big inputs; production jobs
    should prefer ``read_json_schema``.
    """
    return (
        spark.read.option("samplingRatio", sampling_ratio)
        .option("allowNonNumericNumbers", "true")
        .json(path)
    )


def _json_type(kind: T.DataType) -> T.DataType:
    """What JSON inference calls a type that was found through VARIANT: fractions are doubles, whole numbers beyond a
    long are decimals, and values of several types are text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _json_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_json_type(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return kind if kind.scale == 0 and kind.precision > 20 else T.DoubleType()
    return T.StringType() if isinstance(kind, (T.VariantType, T.NullType)) else kind


def read_json_stored(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines or one-line top-level arrays with inferred types, from one scan of the files.

    The lines are stored once as Parquet, and while they are written Spark merges their types through VARIANT; the rows are then
    parsed from the stored lines by these types. Types are those of ``read_json_inferred``: a field with
    numbers and text is text, as it stands in the file, and lines that are not JSON add the corrupt-record column.
    The stored lines last as long as the frame may be read (see ``stage_table``).
    """
    lines = spark.read.text(path)
    rest = [c for c in lines.columns if c != "value"]  # partition columns
    elements = F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", "array<string>")).otherwise(F.array("value"))
    lines = lines.select(F.explode(elements).alias("value"), *rest).where(F.trim("value") != "")
    # not-a-number values are numbers for the types; the stored lines keep them
    plain = F.regexp_replace("value", r"(?<=[:\[,])\s*[+-]?(NaN|INF|Infinity)\s*(?=[,}\]])", "0.5")
    parsed = F.try_parse_json(plain)
    is_row = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    metrics = {"types": F.schema_of_variant_agg(F.when(is_row, parsed)), "bad": F.count_if(~is_row)}
    stored, found = stage_table_observed(lines, "json-lines", metrics, compression="zstd")  # text that repeats itself
    types = found["types"] or "VOID"
    schema = _json_type(T.DataType.fromDDL(types.replace("OBJECT<", "STRUCT<"))) if types.startswith("OBJECT<") else T.StructType([])
    options = {"allowNonNumericNumbers": "true"}
    if found["bad"]:
        schema = T.StructType([T.StructField(CORRUPT_COLUMN, T.StringType()), *schema.fields])
        options["columnNameOfCorruptRecord"] = CORRUPT_COLUMN
    return stored.select(F.from_json("value", schema, options).alias("_r"), *rest).select("_r.*", *rest)


def read_json_schema(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    mode: str = "PERMISSIVE",
    keep_corrupt: bool = False,
) -> DataFrame:
    """JSON with a fixed schema.

    PERMISSIVE (default) turns values of the wrong type into NULL; with
    ``keep_corrupt`` the raw text of unparsable lines lands in
    ``_corrupt_record`` so a caller can quarantine it. ``mode="FAILFAST"``
    raises on the first bad record instead.
    """
    reader = spark.read.option("mode", mode).option("allowNonNumericNumbers", "true")
    if keep_corrupt:
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.schema(schema).json(path)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to keep without the corrupt column, quarantined raw lines).

    A line that is not JSON at all (every field NULL, raw text in the corrupt
    column) is quarantined. A JSON line with a wrong-typed value keeps its row
    with that field NULL, as a plain PERMISSIVE read would.
    """
    if CORRUPT_COLUMN not in df.columns:
        return df, df.limit(0)
    data = [c for c in df.columns if c != CORRUPT_COLUMN]
    any_value = F.lit(False)
    for c in data:
        any_value = any_value | F.col(c).isNotNull()
    garbage = F.col(CORRUPT_COLUMN).isNotNull() & ~any_value
    good = df.filter(~garbage).drop(CORRUPT_COLUMN)
    bad = df.filter(garbage).select(CORRUPT_COLUMN)
    return good, bad


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv_trimmed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Headed CSV; header names are trimmed (``' RoomArea '`` -> ``RoomArea``).

    With a schema the header only serves for trimming; without one every
    column is a string and the cleaners cast.
    """
    reader = spark.read.option("header", "true")
    df = reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


def run_table_query(
    spark: SparkSession, sql_text: str, views: dict[str, DataFrame] | None = None, **binds
) -> DataFrame:
    """Parameterised SQL (``:name`` markers) against catalog tables or the given
    frames, registered as temporary views first; binds are never concatenated."""
    for name, frame in (views or {}).items():
        frame.createOrReplaceTempView(name)
    return spark.sql(sql_text, args=binds or None)


def pushed_counts(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    """Rows of a Parquet folder (column cnt), by partition columns if given, from the files' footers: no row is read.

    The count is pushed into the V2 reader. Its settings are those of a session of its own, so the caller's stay.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "csv,json,orc,text,avro,kafka")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    rows = own.read.parquet(path)
    return rows.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("cnt"))


def has_rows(spark: SparkSession, name: str) -> bool:
    """Whether a table exists and holds a row: one row is looked for, none are counted."""
    return spark.catalog.tableExists(name) and not spark.table(name).isEmpty()


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
