"""Registered queries vs their DuckDB oracles on the smallest driver tables."""

import duckdb
import pytest

from tools.oracle_check import TABLES, rows_key

NAMES = [
    "clean_readings", "stage_counts", "energy_by_building", "topk_efficiency", "iqr_filter", "quantiles",
    "to_silver", "fact_energy", "dim_date", "merge_upsert", "dedup_key", "stamp_batches", "building_health",
    "report_top_types", "report_alerts", "normalize_category", "ml_index", "ml_onehot", "ml_assemble_etl", "ml_assemble_model",
    "ml_linear_regression", "ml_predict", "ml_evaluate", "sink_model", "publish_tables", "report_kpis__both",
]


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, duck, name):
    import __spark_entry__ as E

    sdf = E.queries()[name](spark, sf_small)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    srows = [tuple(r[c] for c in sorted(sdf.columns)) for r in sdf.collect()]
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = [tuple(r[i] for i in order) for r in res.fetchall()]
    assert len(srows) == len(drows)
    assert rows_key(srows, True) == rows_key(drows, True)
