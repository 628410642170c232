"""Queries for the streaming ingest, batch stamping and Kafka value decoding."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from joulebox.queries import sql as S
from joulebox.queries.q_star import fresh
from joulebox.registry import register
from joulebox.schema import RAW_READING
from joulebox.sources import testdata
from joulebox.sources.kafka import decode_json
from joulebox.sources.topic import publish, topic_stream
from joulebox.streaming.batches import stamp_batches
from joulebox.streaming.ingest import collect_topic, write_epochs

LINEITEM_ORDER = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]
INGESTED_AT = "2024-01-01 00:00:00"


#: Rows of a micro-batch of the stream queries.
EPOCH_ROWS = 200_000


@register("stream_ingest", S.with_silver("SELECT * FROM raw"))
def q_stream_ingest(spark, sf):
    """Raw readings through a topic and the collector: a run that stops early, then one to the topic's end."""
    path, target, ckpt = fresh(spark, "topic"), fresh(spark, "raw-stream"), fresh(spark, "raw-stream-ckpt")
    publish(testdata.raw_readings(spark, sf), path, ["RecordID"])
    collect_topic(spark, path, RAW_READING, target, ckpt, max_rows=EPOCH_ROWS, stop_after=EPOCH_ROWS // 20)
    collect_topic(spark, path, RAW_READING, target, ckpt, max_rows=EPOCH_ROWS)
    return spark.read.parquet(target).drop("epoch")


@register(
    "stamp_batches",
    f"""SELECT printf('REC-%06d', rn) AS RecordID, l_orderkey, l_linenumber, l_extendedprice,
       'power_consumption_sensor' AS source, '{INGESTED_AT}' AS ingested_at, printf('POWER-BATCH-%04d', rn // 50 + 1) AS batch_id
FROM (SELECT *, row_number() OVER (ORDER BY {', '.join(LINEITEM_ORDER)}) - 1 AS rn FROM lineitem)""",
)
def q_stamp_batches(spark, sf):
    li = testdata.table(spark, sf, "lineitem")
    stamped = stamp_batches(li, LINEITEM_ORDER, 50, ingested_at=INGESTED_AT)
    return stamped.select("RecordID", "l_orderkey", "l_linenumber", "l_extendedprice", "source", "ingested_at", "batch_id")


EVENT_VALUE = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


@register(
    "scan_kafka",
    """SELECT event_id, user_id, event_type, value, 'events' AS topic, CAST(rn % 3 AS INTEGER) AS "partition", rn // 3 AS "offset"
FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS rn FROM events)""",
)
def q_scan_kafka(spark, sf):
    """The events as a topic of JSON values, read from the earliest offset in two runs of one query."""
    path, target, ckpt = fresh(spark, "topic"), fresh(spark, "events-stream"), fresh(spark, "events-ckpt")
    ev = testdata.events(spark, sf).select("event_id", "user_id", "event_type", "value")
    publish(ev, path, ["event_id"], key=F.col("user_id").cast("string"))
    for rows in (1000, None):  # the second run starts from the first one's checkpoint
        stream = topic_stream(spark, path, "events", ckpt, stop_after=rows)
        decoded = stream.select(decode_json("value", EVENT_VALUE).alias("v"), "topic", "partition", "offset").select("v.*", "topic", "partition", "offset")
        query = write_epochs(decoded, target, ckpt)
        query.processAllAvailable()
        query.stop()
    return spark.read.parquet(target).drop("epoch")


@register("fn_json_decode", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def q_fn_json_decode(spark, sf):
    ev = testdata.events(spark, sf)
    return ev.select("event_id", decode_json("props", "k int").getField("k").alias("k"))
