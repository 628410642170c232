"""joulebox: building-energy analytics on Spark DataFrames.

Sub-packages:
  sources    readers (JSON, parquet, CSV, catalog SQL, Kafka) and the driver-table adapter
  functions  Column -> Column helpers (categories, numbers, dates, text)
  operators  DataFrame -> DataFrame building blocks (cleaning, quantiles, dedup, joins, aggregates)
  plans      composite jobs: readings clean-up, medallion star schema, loading, model, reports
  streaming  Structured Streaming ingest and batch stamping
"""

__all__ = ["sources", "functions", "operators", "plans", "streaming"]
