"""Readers: files, catalog SQL, Kafka, and the driver-table adapter."""

from joulebox.sources.files import (
    read_csv_trimmed,
    read_json_inferred,
    read_json_schema,
    read_parquet,
    run_table_query,
    split_corrupt,
    table_exists,
)
from joulebox.sources.kafka import decode_json, decode_values, kafka_stream

__all__ = [
    "read_csv_trimmed",
    "read_json_inferred",
    "read_json_schema",
    "read_parquet",
    "run_table_query",
    "split_corrupt",
    "table_exists",
    "decode_json",
    "decode_values",
    "kafka_stream",
]
