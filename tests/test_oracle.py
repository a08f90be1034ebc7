"""Differential test: registered queries vs their DuckDB oracle on sf0.001.

The default run covers a representative set; ``SETTLEKIT_FULL_ORACLE=1``
runs every registered query with an oracle.
"""

import os

import pytest

import __spark_entry__ as entry
from settlekit.plans import catalog
from tools.check_oracle import duck, rows_key

from paths import SF_SMALL

CORE = ["promote_latest", "reconcile", "fct_transactions", "fct_current_argmax", "fct_current_row",
        "dim_date", "mart_transactions", "kpi_volume_by_day", "kpi_headline", "revenue_by_partner",
        "kpi_declines_by_partner", "audit_reconciliation", "audit_join_integrity", "orphans_except",
        "dq_suite", "dq_no_digit_run", "canonicalize_rows", "json_decode", "merge_lookback", "chart_query",
        "fct_current", "message_envelope", "drain_range_then_rest", "drain_replay_same_sink", "pipeline_gold"]
NAMES = sorted(catalog.ORACLE) if os.environ.get("SETTLEKIT_FULL_ORACLE") else CORE


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_is_registered_and_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(catalog.QUERIES) >= 60 and set(catalog.ORACLE) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert rows_key(s_rows, sdf.columns) == rows_key(d_rows, d_cols)


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "partner_id" and df.count() > 0


@pytest.mark.parametrize("name", ["kpi_volume_by_day", "kpi_weekly_gross_net", "canonicalize_rows", "dim_date"])
def test_results_do_not_depend_on_the_session_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_query_matches_duckdb(spark, con, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
