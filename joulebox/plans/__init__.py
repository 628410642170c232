"""Composite jobs built from the operators.

readings   clean-up, stage report, features, consumption aggregates
medallion  bronze / silver / gold star schema
loading    sinks and load strategies (load once, SCD0 dims, MERGE upsert, swap, ledger)
model      MLlib pipeline, line predictions, building health
reports    dashboard report queries
jobs       read -> functions -> write entry points (also ``python -m joulebox``)
"""
