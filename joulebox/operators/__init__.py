"""DataFrame -> DataFrame building blocks.

cleaning    projections, predicates, NULL handling, guards
quantiles   approximate and exact (distributed selection) quantiles, the IQR rule
dedup       full-row and deterministic per-key duplicate removal (aggregations)
joins       size-checked broadcast, key lookups, anti join for new keys
aggregates  consumption statistics, flagged share, regression and accuracy metrics
topk        ordered limits with deterministic tie-breaks
indexing    stable row numbering without a single-partition window
"""
