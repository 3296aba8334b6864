"""Registered queries against their SQL on DuckDB. ALL_QUERIES=1 runs every one."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registered

TABLES = "nation customer supplier orders lineitem events".split()
QUICK = [
    "a10_content_checksum", "a13_parsed_requests", "b5_silver_transactions", "c1_dim_users", "c2_dim_merchants",
    "c3_fraud_incidents", "c7_fact_with_velocity", "d4_daily_kpis", "d8_kpi_card", "d17_distance_histogram",
    "e_velocity", "e_velocity_split_users", "g1_keep_first", "i8_gate_summary", "j1_features",
    "j11_stratified_split", "j19_pr_curve_sliced", "k2_reason_codes", "l2_quantile_edges", "m4_named_policies",
    "n2_stream_deduplicated", "n3_stream_daily_kpis", "n5_stream_velocity",
]
NAMES = sorted(registered.oracle_sql()) if os.environ.get("ALL_QUERIES") else QUICK


@pytest.fixture(scope="module")
def db(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _text(value):
    if value is None or value is pd.NaT or value != value:
        return "null"
    return repr(value) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, db, folder, name):
    ours = registered.queries()[name](spark, folder)
    theirs = db.execute(registered.oracle_sql()[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    got = sorted(tuple(_text(r[c]) for c in columns) for r in ours.collect())
    assert got == sorted(tuple(map(_text, r)) for r in theirs.fetchall())


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())
