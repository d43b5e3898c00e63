"""The registered queries against their SQL on the smallest tables, and the contract itself."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from pulsefold.plans.queries import QUERIES

TABLES = ("events", "embeddings")
CHECKED = (
    "processed_table", "clean_median_clip", "glucose_aliases", "scaled_on_train", "union_of_institutions", "roc_auc_by_institution", "synth_vitals", "round_history", "network_scores", "network_step", "rolling_short_series", "rolling_long_series", "constant_fill",
    "institution_split", "train_val_split", "scaled_population", "roc_auc_in_ranges", "weighted_client_metrics",
    "best_round", "client_sample", "fedavg_embeddings", "stream_stats", "stream_series_stats", "stream_restart",
    "fed_mlp_exact", "central_logistic", "compare_models",
)


def ordered(df):
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_contract(spark):
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(queries)
    assert {n for n in set(queries) - set(sql) if n in QUERIES} == {"fed_mlp", "central_mlp", "central_logistic_lbfgs", "compare_networks"}
    assert contract.entry(spark).count() == 1000


@pytest.mark.parametrize("name", CHECKED)
def test_query_against_sql(spark, events_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{events_dir}/{table}.parquet'")
    want = ordered(con.sql(contract.oracle_sql()[name]).df())
    got = ordered(contract.queries()[name](spark, events_dir).toPandas())
    pd.testing.assert_frame_equal(got, want, check_dtype=False, atol=1e-9)
