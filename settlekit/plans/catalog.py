"""Registry of named queries: ``(spark, sf_dir) -> DataFrame`` plus DuckDB oracle SQL.

Every query reads the driver's tables (or what Spark derives from them) and
runs over whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settlekit.contracts import (BANK_COLUMNS, BANK_STATES, FEE_SCHEDULE_ROWS, FEE_SCHEMA,
                                 PARTNER_COLUMNS, PARTNER_SCHEMA)
from settlekit.functions.columns import iso_text
from settlekit.fixtures import VERSION_COLUMNS, Feed
from settlekit.operators import audit as A
from settlekit.operators import canonical as C
from settlekit.operators import metrics as K
from settlekit.operators import quality as Q
from settlekit.operators.dims import DATE_DIM_COLUMNS
from settlekit.operators.mart import MART_COLUMNS
from settlekit.operators.promote import promote
from settlekit.operators.reconcile import (FACT_COLUMNS, RECONCILED_COLUMNS,
                                           current_latest_nonnull, current_latest_row, reconcile, with_fee)
from settlekit.plans import oracle as O
from settlekit.plans import suite as S
from settlekit.plans.model import Model
from settlekit.plans.pipeline import read_gold, run_pipeline
from settlekit.session import scratch_folder
from settlekit.sources import bronze as B
from settlekit.sources import csv_drop as CSV
from settlekit.sources.fs import fingerprint
from settlekit.sources.commits import CommitLog
from settlekit.sources.keyed import KeyedTable
from settlekit.sources.seeds import read_seed_csv
from settlekit.sources.silver import promote_incremental, silver_table
from settlekit.streaming import drain as DR
from settlekit.streaming import ledger as LD
from settlekit.streaming import messages as MSG
from settlekit.streaming import upsert as UP

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _cols(cols) -> str:
    return ", ".join(cols)


# --- promotion, reconciliation, fact, current state ------------------------------

@query("promote_latest", O.with_fixture(f"SELECT {_cols(PARTNER_COLUMNS)} FROM silver_partner", O.SILVER))
def promote_latest(spark, sf):
    return promote(Feed(spark, sf).partner_bronze(), "partner_transactions")


@query("promote_latest_bank", O.with_fixture(f"SELECT {_cols(BANK_COLUMNS)} FROM silver_bank", O.SILVER))
def promote_latest_bank(spark, sf):
    return promote(Feed(spark, sf).bank_bronze(), "bank_transactions")


@query("promote_skip_dedup", O.with_fixture(f"SELECT {_cols(PARTNER_COLUMNS)} FROM fx_partner_bronze"))
def promote_skip_dedup(spark, sf):
    return promote(Feed(spark, sf).partner_bronze(), "partner_transactions", dedup=False)


@query("stg_partner", O.with_fixture(f"SELECT {_cols(PARTNER_COLUMNS)} FROM silver_partner", O.SILVER))
def stg_partner(spark, sf):
    return Model.shared(spark, sf).partner_silver.select(*PARTNER_COLUMNS)


@query("stg_bank", O.with_fixture(f"SELECT {_cols(BANK_COLUMNS)} FROM silver_bank", O.SILVER))
def stg_bank(spark, sf):
    return Model.shared(spark, sf).bank_silver.select(*BANK_COLUMNS)


@query("reconcile", O.with_fixture(f"SELECT {_cols(RECONCILED_COLUMNS)} FROM reconciled", O.SILVER, O.RECONCILED))
def reconcile_q(spark, sf):
    m = Model(spark, sf, materialized=False)
    return reconcile(m.partner_silver, m.bank_silver)


@query("fct_transactions", O.with_fixture(f"SELECT {_cols(FACT_COLUMNS)} FROM fact",
                                          O.SILVER, O.RECONCILED, O.FACT))
def fct_transactions(spark, sf):
    return Model(spark, sf, materialized=False).fact


@query("fct_current_argmax", O.with_fixture(O.current_sql("fx_versions", VERSION_COLUMNS)))
def fct_current_argmax(spark, sf):
    return current_latest_nonnull(Feed(spark, sf).versions())


@query("fct_current_row", O.with_fixture(O.latest_sql("fx_versions", VERSION_COLUMNS)))
def fct_current_row(spark, sf):
    return current_latest_row(Feed(spark, sf).versions())


@query("fct_current", O.on_model(f"SELECT {_cols(FACT_COLUMNS)} FROM ({O.greatest_value_sql('fact_versions', FACT_COLUMNS)})", O.EARLIER_FACT))
def fct_current(spark, sf):
    """Current state over a fact that holds several versions: the one built at the merge
    cutoff, and today's appended to it."""
    feed, today = Feed(spark, sf), Model.shared(spark, sf)
    before = F.col("updated_at") < F.lit(O.EARLIER).cast("timestamp_ntz")
    earlier = with_fee(reconcile(promote(feed.partner_bronze().filter(before), "partner_transactions"),
                                 promote(feed.bank_bronze().filter(before), "bank_transactions")), today.fee_schedule)
    return current_latest_nonnull(earlier.unionByName(today.fact))


# --- dimensions and mart ------------------------------------------------------------

@query("dim_partner", O.on_model("SELECT partner_key, partner_id FROM dim_partner"))
def dim_partner(spark, sf):
    return Model.shared(spark, sf).dim_partner


@query("dim_bank", O.on_model("SELECT bank_key, bank_id FROM dim_bank"))
def dim_bank(spark, sf):
    return Model.shared(spark, sf).dim_bank


@query("dim_decline_reason", O.on_model("SELECT decline_reason_key, decline_reason FROM dim_decline_reason"))
def dim_decline_reason(spark, sf):
    return Model.shared(spark, sf).dim_decline_reason


@query("dim_date", O.on_model(f"SELECT {_cols(DATE_DIM_COLUMNS)} FROM dim_date"))
def dim_date(spark, sf):
    return Model.shared(spark, sf).dim_date


@query("mart_transactions", O.on_model(f"SELECT {_cols(MART_COLUMNS)} FROM mart"))
def mart_transactions(spark, sf):
    return Model.shared(spark, sf).mart


# --- KPI charts -----------------------------------------------------------------------

def _mart(spark, sf) -> DataFrame:
    return Model.shared(spark, sf).mart


def _current(spark, sf) -> DataFrame:
    """For charts of measures alone: the mart's rows without the joins to the dimensions."""
    return Model.shared(spark, sf).current


@query("kpi_volume_by_day", O.on_model(
    "SELECT date_trunc('day', initiated_at) AS initiated_at, count(*) AS count FROM mart "
    "GROUP BY 1 ORDER BY 1 DESC NULLS LAST"))
def kpi_volume_by_day(spark, sf):
    return K.volume_by_day(_mart(spark, sf))


@query("kpi_gross_volume", O.on_model(f"SELECT {O.GROSS_VOLUME} AS gross_volume_usd FROM mart"))
def kpi_gross_volume(spark, sf):
    return K.gross_volume(_current(spark, sf))


@query("kpi_net_volume", O.on_model(f"SELECT {O.NET_VOLUME} AS net_volume_usd FROM mart"))
def kpi_net_volume(spark, sf):
    return K.net_volume(_current(spark, sf))


@query("kpi_weekly_gross_net", O.on_model(
    f"SELECT week_start, {O.GROSS_VOLUME} AS gross_volume_usd, {O.NET_VOLUME} AS net_volume_usd "
    "FROM mart GROUP BY week_start ORDER BY week_start DESC NULLS LAST"))
def kpi_weekly_gross_net(spark, sf):
    return K.weekly_gross_net(_mart(spark, sf))


@query("kpi_auth_rate", O.on_model(f"SELECT {O.AUTH_RATE} AS auth_rate_pct FROM mart"))
def kpi_auth_rate(spark, sf):
    return K.auth_rate(_current(spark, sf))


@query("kpi_settlement_rate", O.on_model(f"SELECT {O.SETTLEMENT_RATE} AS settlement_rate_pct FROM mart"))
def kpi_settlement_rate(spark, sf):
    return K.settlement_rate(_current(spark, sf))


@query("kpi_gross_revenue", O.on_model(f"SELECT {O.GROSS_REVENUE} AS gross_revenue_usd FROM mart"))
def kpi_gross_revenue(spark, sf):
    return K.gross_revenue(_current(spark, sf))


@query("kpi_net_revenue", O.on_model(f"SELECT {O.NET_REVENUE} AS net_revenue_usd FROM mart"))
def kpi_net_revenue(spark, sf):
    return K.net_revenue(_current(spark, sf))


def _by(dim: str) -> str:
    return (f"SELECT {dim}, count(*) AS count FROM mart GROUP BY {dim} "
            f"ORDER BY count DESC, {dim}")


def _declines_by(dim: str) -> str:
    return (f"SELECT {dim}, effective_decline_reason, count(*) AS count FROM mart "
            f"WHERE effective_decline_reason IS NOT NULL GROUP BY {dim}, effective_decline_reason "
            f"ORDER BY count DESC, {dim}, effective_decline_reason")


@query("kpi_volume_by_bank", O.on_model(_by("bank_id")))
def kpi_volume_by_bank(spark, sf):
    return K.volume_by(_mart(spark, sf), "bank_id")


@query("kpi_volume_by_partner", O.on_model(_by("partner_id")))
def kpi_volume_by_partner(spark, sf):
    return K.volume_by(_mart(spark, sf), "partner_id")


@query("kpi_declines_by_bank", O.on_model(_declines_by("bank_id")))
def kpi_declines_by_bank(spark, sf):
    return K.declines_by(_mart(spark, sf), "bank_id")


@query("kpi_declines_by_partner", O.on_model(_declines_by("partner_id")))
def kpi_declines_by_partner(spark, sf):
    return K.declines_by(_mart(spark, sf), "partner_id")


@query("kpi_headline", O.on_model(
    f"SELECT {O.GROSS_VOLUME} AS gross_volume_usd, {O.NET_VOLUME} AS net_volume_usd, "
    f"{O.AUTH_RATE} AS auth_rate_pct, {O.SETTLEMENT_RATE} AS settlement_rate_pct, "
    f"{O.GROSS_REVENUE} AS gross_revenue_usd, {O.NET_REVENUE} AS net_revenue_usd, "
    "count(*) AS transactions FROM mart"))
def kpi_headline(spark, sf):
    return K.headline(_current(spark, sf))


REVENUE_BY_PARTNER_SQL = O.on_model(
    f"SELECT partner_id, count(*) AS transactions, {O.GROSS_VOLUME} AS gross_volume_usd, "
    f"{O.NET_VOLUME} AS net_volume_usd, {O.GROSS_REVENUE} AS gross_revenue_usd, "
    f"{O.NET_REVENUE} AS net_revenue_usd FROM mart GROUP BY partner_id "
    "ORDER BY gross_revenue_usd DESC NULLS LAST, partner_id")


@query("revenue_by_partner", REVENUE_BY_PARTNER_SQL)
def revenue_by_partner(spark, sf):
    return K.revenue_by_partner(_mart(spark, sf))


#: The chart's own row limit (a top-k report).
CHART_ROW_LIMIT = 10000


@query("chart_query", O.on_model(
    "SELECT date_trunc('month', initiated_at) AS initiated_at, bank_id, count(*) AS count, "
    f"{O.GROSS_REVENUE} AS gross_revenue_usd FROM mart WHERE initiated_at IS NOT NULL "
    f"GROUP BY 1, 2 ORDER BY 1 DESC NULLS LAST, 2 LIMIT {CHART_ROW_LIMIT}"))
def chart_query(spark, sf):
    """The generic chart operator with every knob: filter, time grain, group-by, limit."""
    return K.chart_query(_mart(spark, sf), {"count": K.count_rows(), "gross_revenue_usd": K.metric_gross_revenue()},
                         x_axis="initiated_at", time_grain="P1M", groupby=["bank_id"],
                         filters=[{"col": "initiated_at", "op": "IS NOT NULL"}], row_limit=CHART_ROW_LIMIT)


# --- audits ------------------------------------------------------------------------------



@query("audit_reconciliation", O.on_model("""
SELECT count(*) AS total_rows,
  count(*) - count(DISTINCT transaction_id) AS duplicate_transaction_ids,
  count_if(initiated_at IS NULL AND bank_id IS NOT NULL) AS bank_only_rows,
  count_if(initiated_at IS NOT NULL AND bank_state IS NULL) AS partner_only_rows,
  count_if((captured_at IS NOT NULL OR bank_captured_at IS NOT NULL) AND fee_amount_cents IS NULL) AS captured_without_fee,
  count_if(fee_amount_cents IS NOT NULL) AS rows_with_fee
FROM current_fact"""))
def audit_reconciliation(spark, sf):
    return A.reconciliation_audit(Model.shared(spark, sf).current)


@query("audit_catalog", O.on_model("""
SELECT count(DISTINCT CAST(initiated_at AS DATE)) AS distinct_days,
  count(DISTINCT partner_id) AS partners, count(DISTINCT bank_id) AS banks
FROM current_fact"""))
def audit_catalog(spark, sf):
    return A.catalog_audit(Model.shared(spark, sf).current)


@query("audit_rate_spread", O.on_model("""
SELECT count(*) AS partners, round(min(rate), 6) AS min_rate, round(max(rate), 6) AS max_rate,
  round(max(rate) - min(rate), 3) AS rate_spread
FROM (SELECT partner_id, CAST(count_if(state <> 'failed' OR bank_state <> 'failed') AS DOUBLE) / count(*) AS rate
      FROM current_fact GROUP BY partner_id)"""))
def audit_rate_spread(spark, sf):
    return A.rate_spread_audit(Model.shared(spark, sf).current)


@query("audit_fee_coverage", O.on_model("""
SELECT count(*) AS pairs, count_if(f.fixed_fee_cents IS NULL OR f.fixed_fee_cents = 0) AS missing_pairs
FROM (SELECT DISTINCT partner_id, bank_id FROM current_fact) p
LEFT JOIN fee_schedule f ON p.partner_id = f.partner_id AND p.bank_id = f.bank_id"""))
def audit_fee_coverage(spark, sf):
    m = Model.shared(spark, sf)
    return A.fee_coverage_audit(m.current, m.fee_schedule)


@query("orphans_except", O.with_fixture("""
SELECT 'partner_only' AS side, count(*) AS orphans FROM (
  SELECT transaction_id FROM fx_partner EXCEPT SELECT transaction_id FROM fx_bank)
UNION ALL
SELECT 'bank_only' AS side, count(*) AS orphans FROM (
  SELECT transaction_id FROM fx_bank EXCEPT SELECT transaction_id FROM fx_partner)"""))
def orphans_except(spark, sf):
    f = Feed(spark, sf)
    return A.orphans_except(f.partner(), f.bank())


def _baseline_sql(side: str, this: str, other: str) -> str:
    return f"""SELECT '{side}' AS side, count(*) AS rows,
  count(*) - count(DISTINCT transaction_id) AS duplicate_ids,
  count_if(transaction_id IN (SELECT transaction_id FROM {other})) AS matched_ids,
  count_if(bank_id IS NOT NULL AND transaction_id IN (SELECT transaction_id FROM {other})) AS matched_nonnull_bank_id,
  count_if(decline_reason IS NOT NULL AND transaction_id IN (SELECT transaction_id FROM {other})) AS matched_nonnull_decline_reason
FROM {this}"""


@query("audit_match_baseline", O.with_fixture(
    _baseline_sql("partner", "silver_partner", "silver_bank") + "\nUNION ALL\n"
    + _baseline_sql("bank", "silver_bank", "silver_partner"), O.SILVER))
def audit_match_baseline(spark, sf):
    m = Model.shared(spark, sf)
    return A.match_baseline(m.partner_silver, m.bank_silver)


@query("audit_join_integrity", O.with_fixture("""
SELECT j.*, (total_rows = expected_total_rows AND matched_nonnull_p_bank_id = expected_nonnull_p_bank_id
    AND matched_nonnull_b_bank_id = expected_nonnull_b_bank_id
    AND matched_nonnull_decline_reason = expected_nonnull_decline_reason
    AND matched_nonnull_bank_decline_reason = expected_nonnull_bank_decline_reason) AS integrity_ok
FROM (SELECT
  count(*) AS total_rows,
  count_if(p.transaction_id IS NOT NULL AND b.transaction_id IS NOT NULL) AS matched_rows,
  (SELECT count(*) FROM silver_partner) + (SELECT count(*) FROM silver_bank)
    - (SELECT count(*) FROM silver_partner WHERE transaction_id IN (SELECT transaction_id FROM silver_bank)) AS expected_total_rows,
  count_if(p.transaction_id IS NOT NULL AND b.transaction_id IS NOT NULL AND p.bank_id IS NOT NULL) AS matched_nonnull_p_bank_id,
  (SELECT count(*) FROM silver_partner WHERE bank_id IS NOT NULL AND transaction_id IN (SELECT transaction_id FROM silver_bank)) AS expected_nonnull_p_bank_id,
  count_if(p.transaction_id IS NOT NULL AND b.transaction_id IS NOT NULL AND b.bank_id IS NOT NULL) AS matched_nonnull_b_bank_id,
  (SELECT count(*) FROM silver_bank WHERE bank_id IS NOT NULL AND transaction_id IN (SELECT transaction_id FROM silver_partner)) AS expected_nonnull_b_bank_id,
  count_if(p.transaction_id IS NOT NULL AND b.transaction_id IS NOT NULL AND p.decline_reason IS NOT NULL) AS matched_nonnull_decline_reason,
  (SELECT count(*) FROM silver_partner WHERE decline_reason IS NOT NULL AND transaction_id IN (SELECT transaction_id FROM silver_bank)) AS expected_nonnull_decline_reason,
  count_if(p.transaction_id IS NOT NULL AND b.transaction_id IS NOT NULL AND b.decline_reason IS NOT NULL) AS matched_nonnull_bank_decline_reason,
  (SELECT count(*) FROM silver_bank WHERE decline_reason IS NOT NULL AND transaction_id IN (SELECT transaction_id FROM silver_partner)) AS expected_nonnull_bank_decline_reason
FROM silver_partner p FULL OUTER JOIN silver_bank b ON p.transaction_id = b.transaction_id) j""", O.SILVER))
def audit_join_integrity(spark, sf):
    m = Model.shared(spark, sf)
    return A.join_integrity(m.partner_silver, m.bank_silver)


@query("audit_null_keys", O.with_fixture("""
SELECT 'partner_transactions' AS table_name, count(*) AS rows,
  count_if(transaction_id IS NULL OR state IS NULL) AS null_key_rows,
  count(*) > 0 AND count_if(transaction_id IS NULL OR state IS NULL) = 0 AS ok FROM fx_partner
UNION ALL
SELECT 'bank_transactions', count(*), count_if(transaction_id IS NULL OR state IS NULL),
  count(*) > 0 AND count_if(transaction_id IS NULL OR state IS NULL) = 0 FROM fx_bank"""))
def audit_null_keys(spark, sf):
    f = Feed(spark, sf)
    return A.null_keys_audit({"partner_transactions": f.partner(), "bank_transactions": f.bank()})


@query("audit_chart_total", O.on_model("""
SELECT CAST((SELECT sum(cnt) FROM (SELECT date_trunc('day', initiated_at) AS d, count(*) AS cnt FROM mart GROUP BY 1)) AS BIGINT) AS chart_total,
  CAST((SELECT count(*) FROM current_fact) AS BIGINT) AS fact_total,
  (SELECT sum(cnt) FROM (SELECT date_trunc('day', initiated_at) AS d, count(*) AS cnt FROM mart GROUP BY 1))
    = (SELECT count(*) FROM current_fact) AS matches"""))
def audit_chart_total(spark, sf):
    m = Model.shared(spark, sf)
    return A.chart_total_audit(K.volume_by_day(m.mart), "count", m.current)


@query("audit_channel_coverage", O.with_fixture("""
SELECT table_name, channel, rows, count(*) OVER (PARTITION BY table_name) AS table_channels,
  count(*) OVER (PARTITION BY table_name) >= 2 AS ok
FROM (SELECT 'partner_transactions' AS table_name, channel, count(*) AS rows FROM fx_partner_bronze GROUP BY channel
      UNION ALL
      SELECT 'bank_transactions', channel, count(*) FROM fx_bank_bronze GROUP BY channel)"""))
def audit_channel_coverage(spark, sf):
    f = Feed(spark, sf)
    return A.channel_coverage_audit({"partner_transactions": f.partner_bronze(),
                                     "bank_transactions": f.bank_bronze()})


# --- data-quality checks ----------------------------------------------------------------------

@query("dq_not_null", O.with_fixture(
    "SELECT transaction_id, state FROM reconciled WHERE state IS NULL", O.SILVER, O.RECONCILED))
def dq_not_null(spark, sf):
    """not_null on the partner state of the reconciled table: the bank-only rows."""
    return Q.not_null(Model.shared(spark, sf).reconciled, "state").select("transaction_id", "state")


@query("dq_unique", O.with_fixture(
    "SELECT transaction_id, count(*) AS n_records FROM fx_partner_bronze WHERE transaction_id IS NOT NULL "
    "GROUP BY transaction_id HAVING count(*) > 1"))
def dq_unique(spark, sf):
    """unique on bronze transaction ids: the re-delivered ids (before promotion)."""
    return Q.unique(Feed(spark, sf).partner_bronze(), "transaction_id")


@query("dq_accepted_values", O.with_fixture(
    "SELECT state, count(*) AS n_records FROM fx_versions WHERE state IS NOT NULL AND state NOT IN ("
    + ", ".join(f"'{v}'" for v in BANK_STATES) + ") GROUP BY state"))
def dq_accepted_values(spark, sf):
    """accepted_values (bank vocabulary) over all versions: the 'initiated' rows fail."""
    return Q.accepted_values(Feed(spark, sf).versions(), "state", BANK_STATES)


@query("dq_relationships", O.with_fixture(
    "SELECT transaction_id FROM fx_bank b WHERE transaction_id IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM fx_partner p WHERE p.transaction_id = b.transaction_id)"))
def dq_relationships(spark, sf):
    """relationships: bank transaction ids with no partner transaction."""
    f = Feed(spark, sf)
    return Q.relationships(f.bank(), "transaction_id", f.partner(), "transaction_id")


@query("dq_no_digit_run", "SELECT doc_id, text FROM documents WHERE regexp_matches(text, "
       r"'(^|[^0-9])[0-9]{13,19}([^0-9]|$)')")
def dq_no_digit_run(spark, sf):
    """no_pan_like_values over whole document texts."""
    return Q.no_digit_run(Feed(spark, sf).table("documents").select("doc_id", "text"), "text")


FRESHNESS_NOW = "2001-08-03 06:00:00"


@query("dq_freshness", O.with_fixture(f"""
SELECT table_name, max_loaded_at, snapshotted_at, round(age_hours, 6) AS age_hours,
  CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN age_hours > 8 THEN 'error'
       WHEN age_hours > 4 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT table_name, max_loaded_at, TIMESTAMP '{FRESHNESS_NOW}' AS snapshotted_at,
        (epoch_us(TIMESTAMP '{FRESHNESS_NOW}') - epoch_us(max_loaded_at)) / 3.6e9 AS age_hours
      FROM (SELECT 'silver_partner_transactions' AS table_name, max(updated_at) AS max_loaded_at FROM silver_partner
            UNION ALL
            SELECT 'silver_bank_transactions', max(updated_at) FROM silver_bank))""", O.SILVER))
def dq_freshness(spark, sf):
    m = Model.shared(spark, sf)
    p = Q.freshness(m.partner_silver, "updated_at", FRESHNESS_NOW)
    b = Q.freshness(m.bank_silver, "updated_at", FRESHNESS_NOW)
    return (p.select(F.lit("silver_partner_transactions").alias("table_name"), "*")
             .unionByName(b.select(F.lit("silver_bank_transactions").alias("table_name"), "*")))


@query("dq_suite", O.on_model(S.suite_sql()))
def dq_suite(spark, sf):
    return S.suite_results(Model.shared(spark, sf))


def _freshness_rows_sql(name: str, source: str) -> str:
    age = f"(epoch_us(TIMESTAMP '{FRESHNESS_NOW}') - epoch_us(max(updated_at))) / 3.6e9"
    status = f"CASE WHEN max(updated_at) IS NULL OR {age} > 8 THEN 'error' WHEN {age} > 4 THEN 'warn' ELSE 'pass' END"
    return (f"SELECT '{name}' AS model, 'updated_at' AS column_name, 'freshness' AS test, "
            f"CAST(CASE WHEN {status} = 'pass' THEN 0 ELSE 1 END AS BIGINT) AS failures, "
            f"CASE WHEN {status} = 'error' THEN 'error' ELSE 'warn' END AS severity, {status} AS status FROM {source}")


@query("dq_severity", O.on_model(f"""
SELECT alert_level, count(*) AS checks, CAST(sum(failures) AS BIGINT) AS failing_rows FROM (
  SELECT failures, CASE WHEN status IN ('fail', 'error') THEN 'critical' WHEN status = 'warn' THEN 'warning'
                        ELSE 'ok' END AS alert_level
  FROM ({S.suite_sql()}
        UNION ALL {_freshness_rows_sql('silver_partner_transactions', 'silver_partner')}
        UNION ALL {_freshness_rows_sql('silver_bank_transactions', 'silver_bank')})) GROUP BY alert_level"""))
def dq_severity(spark, sf):
    """Alert levels over the declared checks plus the silver freshness checks."""
    m = Model.shared(spark, sf)
    fresh = Q.freshness_results({"silver_partner_transactions": m.partner_silver,
                                 "silver_bank_transactions": m.bank_silver}, "updated_at", FRESHNESS_NOW)
    return Q.severity_rollup(S.suite_results(m).unionByName(fresh))


@query("dq_dup_caught", O.with_fixture("""
SELECT 'dedup_off' AS variant, count(*) AS unique_failures, CASE WHEN count(*) > 0 THEN 'fail' ELSE 'pass' END AS status
FROM (SELECT transaction_id FROM fx_partner_bronze GROUP BY transaction_id HAVING count(*) > 1)
UNION ALL
SELECT 'dedup_on', count(*), CASE WHEN count(*) > 0 THEN 'fail' ELSE 'pass' END
FROM (SELECT transaction_id FROM silver_partner GROUP BY transaction_id HAVING count(*) > 1)""", O.SILVER))
def dq_dup_caught(spark, sf):
    """Regression proof: the unique check fails with dedup off and passes with it on."""
    bronze = Feed(spark, sf).partner_bronze()
    out = None
    for variant, dedup in (("dedup_off", False), ("dedup_on", True)):
        silver = promote(bronze, "partner_transactions", dedup=dedup)
        one = Q.unique(silver, "transaction_id").agg(F.count(F.lit(1)).alias("unique_failures")).select(
            F.lit(variant).alias("variant"), "unique_failures",
            F.when(F.col("unique_failures") > 0, "fail").otherwise("pass").alias("status"))
        out = one if out is None else out.unionByName(one)
    return out


# --- sources, canonicalisation, guard, contract --------------------------------------------



_CONTRACT_SELECT = _cols(PARTNER_COLUMNS)


def as_transport_text(df: DataFrame) -> DataFrame:
    """Rows as a file or queue channel carries them: every field text, NULL as
    '', timestamps ISO-8601."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            c = iso_text(c)
        out.append(F.coalesce(c.cast("string"), F.lit("")).alias(f.name))
    return df.select(*out)


@query("canonicalize_rows", O.with_fixture(f"SELECT {_CONTRACT_SELECT} FROM fx_partner_bronze"))
def canonicalize_rows(spark, sf):
    """Transport text of every bronze row -> contract types (round trip is exact). A third
    of the rows carry their times with Z, a third at +02:00, the rest without an offset."""
    text = as_transport_text(with_offsets(Feed(spark, sf).partner_bronze().select(*PARTNER_COLUMNS)))
    return C.canonicalize(text, "partner_transactions")


def with_offsets(df: DataFrame) -> DataFrame:
    """The same instants as text, by row with ``Z``, at ``+02:00`` or as bare UTC wall time."""
    kind = F.pmod(F.xxhash64("transaction_id", "updated_at"), F.lit(3))
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            shifted = iso_text(c + F.make_dt_interval(hours=F.lit(2)))
            c = F.when(kind == 0, F.concat(iso_text(c), F.lit("Z"))).when(kind == 1, F.concat(shifted, F.lit("+02:00"))).otherwise(iso_text(c))
        out.append(c.alias(f.name))
    return df.select(*out)


@query("csv_drop_roundtrip", O.with_fixture(
    f"SELECT {_CONTRACT_SELECT} FROM fx_partner_bronze WHERE channel = 'sftp_drop'"))
def csv_drop_roundtrip(spark, sf):
    """File channel: write the sftp partners' rows as CSV drops in two column
    orders, read them back by header name, canonicalise."""
    folder = scratch_folder(spark, "csv-drop")
    rows = Feed(spark, sf).partner_bronze().filter(F.col("channel") == "sftp_drop").select(*PARTNER_COLUMNS)
    CSV.write_csv_drop(rows.filter(F.col("partner_id") == "partner_globex"), folder,
                       "partner_transactions", "20010801_020000000000", PARTNER_COLUMNS)
    CSV.write_csv_drop(rows.filter(F.col("partner_id") != "partner_globex"), folder,
                       "partner_transactions", "20010801_021500000000", tuple(reversed(PARTNER_COLUMNS)))
    text = CSV.read_csv_drops(spark, folder, "partner_transactions")
    return C.canonicalize(text, "partner_transactions").select(*PARTNER_COLUMNS)


@query("csv_drop_roundtrip_bank", O.with_fixture(
    f"SELECT {_cols(BANK_COLUMNS)} FROM fx_bank_bronze WHERE channel = 'sftp_drop'"))
def csv_drop_roundtrip_bank(spark, sf):
    """File channel, bank side: its drops written as CSV and read back by header name."""
    folder = scratch_folder(spark, "csv-drop-bank")
    rows = Feed(spark, sf).bank_bronze().filter(F.col("channel") == "sftp_drop").select(*BANK_COLUMNS)
    CSV.write_csv_drop(rows, folder, "bank_transactions", "20010801_020000000000", tuple(reversed(BANK_COLUMNS)))
    return C.canonicalize(CSV.read_csv_drops(spark, folder, "bank_transactions"), "bank_transactions").select(*BANK_COLUMNS)


_DIGIT_RUN = r"'(^|[^0-9])[0-9]{13,19}([^0-9]|$)'"


@query("digit_run_scan", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count_if(regexp_matches({c}, {_DIGIT_RUN})) AS matches FROM documents"
    for c in ("text", "lang", "source")))
def digit_run_scan(spark, sf):
    """Identifier guard's scan: every string column of the documents, one aggregation."""
    return C.digit_run_counts(Feed(spark, sf).table("documents"), ["text", "lang", "source"])


@query("schema_drift_report", O.with_fixture("""
SELECT 'sftp_drop' AS source, 'surprise_risk_score' AS column_name, 'new_column' AS kind,
  CAST(NULL AS VARCHAR) AS frozen_type, 'double' AS observed_type, true AS violation,
  count(*) FILTER (WHERE amount_cents % 100 <> 0) AS rows_affected FROM fx_partner
UNION ALL
SELECT 'kafka_drain', 'amount_cents', 'type_changed', 'bigint', 'string', true, count(amount_cents) FROM fx_partner
UNION ALL
SELECT 'kafka_drain', 'initiated_at', 'missing_ok', 'timestamp_ntz', NULL, false, count(*) FROM fx_partner"""))
def schema_drift_report(spark, sf):
    """Contract comparison of three channel feeds (clean; an extra column; a
    retyped and a missing column) with the rows each drift affects."""
    clean = Feed(spark, sf).partner()
    drifted = clean.withColumn("surprise_risk_score",
                               F.when(F.col("amount_cents") % 100 != 0, (F.col("amount_cents") % 100) / 100.0))
    retyped = clean.drop("initiated_at").withColumn("amount_cents", F.col("amount_cents").cast("string"))
    return C.drift_report(PARTNER_SCHEMA, {"partner_db": clean, "sftp_drop": drifted, "kafka_drain": retyped})


_FREEZE_SQL = """
SELECT step, channel, table_name, outcome, frozen_columns, versions, CAST(visible_rows AS BIGINT) AS visible_rows FROM (VALUES
  (1, 'partner_db', 'partner_transactions', 'loaded', 13, 1, (SELECT count(*) FROM fx_partner)),
  (2, 'partner_db', 'partner_transactions', 'refused', 13, 1, (SELECT count(*) FROM fx_partner)),
  (3, 'partner_db', 'partner_transactions', 'refused', 13, 1, (SELECT count(*) FROM fx_partner)),
  (4, 'partner_db', 'partner_transactions', 'refused', 13, 1, (SELECT count(*) FROM fx_partner)),
  (5, 'partner_db', 'partner_transactions', 'loaded', 13, 1, (SELECT count(*) FROM fx_partner WHERE amount_cents % 2 = 0)),
  (6, 'sftp_drop', 'partner_transactions', 'loaded', 14, 1, (SELECT count(*) FROM fx_partner)),
  (7, 'partner_db', 'chargebacks', 'loaded', 2, 1, (SELECT count(*) FROM fx_partner WHERE state = 'refunded')),
  (8, 'partner_db', 'partner_transactions', 'loaded', 14, 2, (SELECT count(*) FROM fx_partner))
) t(step, channel, table_name, outcome, frozen_columns, versions, visible_rows)"""


@query("schema_freeze", O.with_fixture(_FREEZE_SQL))
def schema_freeze(spark, sf):
    """Loads against the schema registry: a channel's first load freezes its columns; new and retyped columns are
    refused before a write; a missing column passes; another channel and a new table freeze by themselves; an approved
    version lets the new column in. After each attempt: the outcome, the registry, the rows that readers see."""
    root = scratch_folder(spark, "schema-freeze")
    full = Feed(spark, sf).partner().select(*PARTNER_COLUMNS)
    first = full.drop("refunded_at")  # what the channel's first run happened to have
    refunds = full.filter(F.col("state") == "refunded").select("transaction_id", F.col("amount_cents").alias("disputed_cents"))
    attempts = [
        ("partner_db", "partner_transactions", first),
        ("partner_db", "partner_transactions", full),  # in the code's contract, but not in what was frozen
        ("partner_db", "partner_transactions", first.withColumn("surprise_risk_score", F.lit(0.97))),
        ("partner_db", "partner_transactions", first.withColumn("amount_cents", F.col("amount_cents").cast("string"))),
        ("partner_db", "partner_transactions", first.drop("failed_at").filter("amount_cents % 2 = 0")),
        ("sftp_drop", "partner_transactions", full),
        ("partner_db", "chargebacks", refunds),
        ("partner_db", "partner_transactions", full)]
    rows = []
    for step, (channel, table, df) in enumerate(attempts, 1):
        if step == len(attempts):
            B.approve_schema(spark, root, channel, table, full.schema)
        try:
            B.write_bronze(df, root, channel, table)
            outcome = "loaded"
        except C.SchemaDriftError:
            outcome = "refused"
        frozen = B.frozen_schema(spark, root, channel, table)
        visible = spark.read.parquet(*B.named_folders(spark, root, table)[channel]).count()
        rows.append((step, channel, table, outcome, len(frozen), len(B.schema_versions(spark, root, channel, table)), visible))
    return spark.createDataFrame(rows, "step int, channel string, table_name string, outcome string, frozen_columns int, versions int, visible_rows bigint")


@query("bronze_union_by_name", O.with_fixture(f"SELECT channel, {_CONTRACT_SELECT} FROM fx_partner_bronze"))
def bronze_union_by_name(spark, sf):
    """Channels with different metadata columns, unioned by name, contract kept."""
    bronze = Feed(spark, sf).partner_bronze()
    by = lambda ch: bronze.filter(F.col("channel") == ch).select(*PARTNER_COLUMNS)
    frames = {
        "partner_db": by("partner_db"),
        "sftp_drop": by("sftp_drop").withColumn(
            "_source_file", F.concat(F.lit("partner_transactions_"), F.date_format("updated_at", "yyyyMMdd"), F.lit(".csv"))),
        "kafka_drain": by("kafka_drain").withColumn(
            "_kafka_msg_id", F.md5(F.concat(F.lit("partner-transactions"), F.lit("0"), F.col("transaction_id")))),
    }
    return B.union_channels(frames, "partner_transactions")


@query("fee_schedule_seed", O.with_fixture("""
SELECT f.partner_id, f.bank_id, f.fixed_fee_cents, f.percentage_bps, count(p.transaction_id) AS transactions
FROM fee_schedule f LEFT JOIN fx_partner p ON f.partner_id = p.partner_id AND f.bank_id = p.bank_id
GROUP BY f.partner_id, f.bank_id, f.fixed_fee_cents, f.percentage_bps"""))
def fee_schedule_seed(spark, sf):
    """The typed CSV seed, with the partner-side volume each fee row prices."""
    folder = scratch_folder(spark, "seed")
    spark.createDataFrame(list(FEE_SCHEDULE_ROWS), FEE_SCHEMA).write.option("header", True).csv(folder)
    seed = read_seed_csv(spark, folder)
    volume = (Feed(spark, sf).partner().groupBy("partner_id", "bank_id")
              .agg(F.count(F.lit(1)).alias("transactions")))
    return (seed.join(volume, ["partner_id", "bank_id"], "left")
                .select("partner_id", "bank_id", "fixed_fee_cents", "percentage_bps",
                        F.coalesce("transactions", F.lit(0)).alias("transactions")))


# --- queue drains (Structured Streaming) -------------------------------------------------------


_EVENT_OUT = ("event_id", "ts", "user_id", "event_type", "value", "props", "k")
_EVENT_SQL = "event_id, ts, user_id, event_type, value, props, CAST(json_extract(props, '$.k') AS INTEGER) AS k"
DRAIN_SPLIT = "2024-01-16 00:00:00"
RANGE_START, RANGE_END = "2024-01-10 00:00:00", "2024-01-20 00:00:00"


def _events(spark, sf) -> DataFrame:
    return Feed(spark, sf).table("events")


@query("message_envelope", """
SELECT CAST(user_id % 4 AS INTEGER) AS partition, 'events.' || event_type AS topic,
  CASE WHEN user_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) END AS key, event_id AS "offset",
  0 AS ts_type, ts AS ts_value,
  '{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","user_id":' || user_id
    || ',"event_type":"' || event_type || '","value":' || CAST(value AS VARCHAR)
    || ',"props":"' || replace(props, '"', '\\"') || '"}' AS data,
  md5('events.' || event_type || CAST(CAST(user_id % 4 AS INTEGER) AS VARCHAR)
      || coalesce(CASE WHEN user_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) END, 'None')) AS _kafka_msg_id
FROM events""")
def message_envelope(spark, sf):
    """Default message record of every event message, body included."""
    env = DR.envelope(MSG.event_messages(_events(spark, sf)))
    return env.select("_kafka.partition", "_kafka.topic", "_kafka.key", "_kafka.offset",
                      F.col("_kafka.ts.type").alias("ts_type"), F.col("_kafka.ts.value").alias("ts_value"),
                      "_kafka.data", "_kafka_msg_id")


@query("json_decode", f"SELECT {_EVENT_SQL} FROM events")
def json_decode(spark, sf):
    """Message bodies (JSON objects) -> typed event rows, nested JSON props too."""
    return MSG.decoded_events(MSG.event_messages(_events(spark, sf))).select(*_EVENT_OUT)


def _log(spark, sf, name: str, segments=None) -> tuple[str, str]:
    """Write the events' message log (optionally in time segments); return
    (log folder, scratch root)."""
    root = scratch_folder(spark, name)
    log = f"{root}/log"
    msgs = MSG.event_messages(_events(spark, sf))
    if segments is None:
        MSG.write_segment(msgs, log)
    else:
        MSG.write_segment(msgs.filter(segments), log)
    return log, root


@query("drain_available_now", f"""
SELECT {_EVENT_SQL}, CASE WHEN ts < TIMESTAMP '{DRAIN_SPLIT}' THEN 1 ELSE 3 END AS drain_run FROM events""")
def drain_available_now(spark, sf):
    """Three bounded drains of a growing log: run 1 reads the first segment, run 2
    finds nothing new and writes nothing, run 3 reads only the appended segment."""
    early = F.col("timestamp") < F.lit(DRAIN_SPLIT).cast("timestamp_ntz")
    log, root = _log(spark, sf, "drain", early)
    bronze, ckpt = f"{root}/bronze", f"{root}/checkpoint"
    decode = lambda b: MSG.decoded_events(b)
    counts = []
    for run in (1, 2, 3):
        if run == 3:
            MSG.write_segment(MSG.event_messages(_events(spark, sf)).filter(~early), log)
        stream = DR.read_log(spark, log, files_per_batch=2)
        counts.append(DR.drain(stream, DR.append_sink(bronze, decode, {"drain_run": run}), ckpt))
    if counts[1] != 0:
        raise AssertionError(f"second drain read {counts[1]} messages; expected none")
    return DR.read_sink(spark, bronze).select(*_EVENT_OUT, "drain_run")


@query("drain_time_range", f"""
SELECT {_EVENT_SQL} FROM events WHERE ts >= TIMESTAMP '{RANGE_START}' AND ts < TIMESTAMP '{RANGE_END}'""")
def drain_time_range(spark, sf):
    """Drain bounded by start_from <= message time < end_time, both turned into offsets first."""
    log, root = _log(spark, sf, "drain-range")
    drain, bronze = _ledger(spark, log, root), f"{root}/bronze"
    drain.run(LD.landing_sink(bronze, MSG.decoded_events), start_from=RANGE_START, end_time=RANGE_END)
    return LD.read_landed(spark, bronze, drain.commits).select(*_EVENT_OUT)


def _ledger(spark, log: str, root: str) -> LD.LedgerDrain:
    return LD.LedgerDrain(LD.MessageLog(spark, log, f"{root}/segments"), CommitLog(spark, f"{root}/ledger"))


@query("drain_range_then_rest", f"SELECT {_EVENT_SQL} FROM events")
def drain_range_then_rest(spark, sf):
    """A drain up to RANGE_END and then an open one on the same ledger land every message once."""
    log, root = _log(spark, sf, "drain-rest")
    drain, bronze = _ledger(spark, log, root), f"{root}/bronze"
    for bounds in ({"start_from": "1970-01-01", "end_time": RANGE_END}, {}):
        drain.run(LD.landing_sink(bronze, MSG.decoded_events), **bounds)
    return LD.read_landed(spark, bronze, drain.commits).select(*_EVENT_OUT)


@query("drain_offsets", f"""
SELECT 'events.' || event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, min(event_id) AS first_offset,
  coalesce(min(event_id) FILTER (WHERE ts >= TIMESTAMP '{RANGE_END}'), max(event_id) + 1) AS bound_offset,
  max(event_id) + 1 AS next_offset, count(*) FILTER (WHERE ts < TIMESTAMP '{RANGE_END}') AS landed_to_bound,
  count(*) FILTER (WHERE ts >= TIMESTAMP '{RANGE_END}') AS landed_after, CAST(0 AS BIGINT) AS landed_again
FROM events GROUP BY ALL""")
def drain_offsets(spark, sf):
    """The ledger per topic and partition: first offset, the offset that RANGE_END stands for, the next offset, and
    the messages that a drain to the bound, one to the end and one more have landed."""
    log, root = _log(spark, sf, "drain-offsets")
    drain, bronze = _ledger(spark, log, root), f"{root}/bronze"
    sink = LD.landing_sink(bronze, lambda b: b.select("topic", "partition", "offset"))
    first = {part: b[0] for part, b in drain.log.bounds(drain.log.segments()).items()}
    runs = []
    for bounds in ({"start_from": "1970-01-01", "end_time": RANGE_END}, {}, {}):
        runs.append((drain.run(sink, **bounds), drain.offsets()))
    landed = LD.read_landed(spark, bronze, drain.commits).groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n")).collect()
    if {(r["topic"], r["partition"]): r["n"] for r in landed} != {p: sum(d.landed.get(p, 0) for d, _ in runs) for p in first}:
        raise AssertionError("what lies in the sink is not what the drains have counted")
    rows = [(*part, first[part], runs[0][1].get(part, first[part]), runs[1][1][part], *[d.landed.get(part, 0) for d, _ in runs]) for part in first]
    return spark.createDataFrame(rows, "topic string, partition int, first_offset bigint, bound_offset bigint, next_offset bigint, "
                                       "landed_to_bound bigint, landed_after bigint, landed_again bigint")


# Table-name overrides of the routing drain (other topics keep their own name).
ROUTES = {"events.purchase": "purchases", "events.error": "error_log"}


@query("drain_route_topics", """
SELECT CASE event_type WHEN 'purchase' THEN 'purchases' WHEN 'error' THEN 'error_log'
  ELSE 'events_' || event_type END AS table_name, event_id, event_type FROM events""")
def drain_route_topics(spark, sf):
    """Each topic lands in its own table: the topic's name, or an override."""
    log, root = _log(spark, sf, "drain-route")
    mapper = lambda b: MSG.decoded_events(b, keep=("table_name",))
    DR.drain(DR.read_log(spark, log), DR.routing_sink(f"{root}/tables", ROUTES, mapper), f"{root}/checkpoint")
    return DR.read_routed(spark, f"{root}/tables").select("table_name", "event_id", "event_type")


@query("drain_replay_dedup", f"SELECT {_EVENT_SQL} FROM events")
def drain_replay_dedup(spark, sf):
    """State loss: the second drain restarts from the earliest message; the
    duplicates are absorbed by dedup on the message coordinates."""
    log, root = _log(spark, sf, "drain-replay")
    bronze = f"{root}/bronze"
    keep = ("topic", "partition", "offset")
    mapper = lambda b: MSG.decoded_events(b, keep=keep)
    for run, ckpt in ((1, "checkpoint-a"), (2, "checkpoint-b")):
        DR.drain(DR.read_log(spark, log), DR.append_sink(bronze, mapper, {"drain_run": run}), f"{root}/{ckpt}")
    landed = DR.read_sink(spark, bronze)
    return landed.dropDuplicates(list(keep)).select(*_EVENT_OUT)


@query("drain_replay_same_sink", f"SELECT {_EVENT_SQL} FROM events")
def drain_replay_same_sink(spark, sf):
    """State loss without any tag of the run: the replay lands beside the first drain's
    batches, and dedup on the message coordinates leaves every event once."""
    log, root = _log(spark, sf, "drain-same")
    keep = ("topic", "partition", "offset")
    mapper = lambda b: MSG.decoded_events(b, keep=keep)
    landed = [DR.drain(DR.read_log(spark, log), DR.append_sink(f"{root}/bronze", mapper), f"{root}/{ckpt}")
              for ckpt in ("checkpoint-a", "checkpoint-b")]
    rows = DR.read_sink(spark, f"{root}/bronze")
    if rows.count() != sum(landed):
        raise AssertionError(f"{sum(landed)} messages were landed, {rows.count()} are there")
    return rows.dropDuplicates(list(keep)).select(*_EVENT_OUT)


@query("late_update_wins", O.with_fixture(O.latest_sql("fx_versions", VERSION_COLUMNS)))
def late_update_wins(spark, sf):
    """Milestone versions arrive newest first, older ones a run later; the
    upserted table still holds the newest version of every transaction."""
    root = scratch_folder(spark, "late-updates")
    versions = Feed(spark, sf).versions()
    newest = versions.filter(F.col("state") != "initiated")
    versions_schema = versions.schema
    newest.write.parquet(f"{root}/arrivals/run=1")
    table, ckpt = f"{root}/silver", f"{root}/checkpoint"
    for run in (1, 2):
        if run == 2:
            versions.filter(F.col("state") == "initiated").write.parquet(f"{root}/arrivals/run=2")
        stream = spark.readStream.schema(versions_schema).parquet(f"{root}/arrivals/run=*")
        DR.drain(stream, UP.versions_sink(table), ckpt)     # each batch appends: O(batch)
        if run == 1:
            UP.fold(spark, table, buckets=16)               # the first run's batches; the late ones are resolved when read
    return UP.read_current(spark, table).select(*VERSION_COLUMNS)


MERGE_CUTOFF, LOOKBACK_DAYS = "1998-01-01 00:00:00", 7


@query("merge_lookback", O.with_fixture(f"SELECT {_cols(PARTNER_COLUMNS)} FROM silver_partner", O.SILVER))
def merge_lookback_q(spark, sf):
    """Incremental merge: silver built before the cutoff, then the last LOOKBACK_DAYS + new rows merged into the
    buckets that they touch; equal to the full rebuild."""
    bronze = Feed(spark, sf).partner_bronze().select(*PARTNER_COLUMNS)
    cutoff = F.lit(MERGE_CUTOFF).cast("timestamp_ntz")
    silver = KeyedTable(spark, scratch_folder(spark, "merge-lookback"), buckets=16)
    silver.merge(bronze.filter(F.col("updated_at") < cutoff))
    silver.merge(bronze.filter(F.col("updated_at") >= cutoff - F.make_dt_interval(F.lit(LOOKBACK_DAYS))))
    return silver.read()


@query("silver_incremental", O.with_fixture(f"SELECT {_cols(PARTNER_COLUMNS)} FROM silver_partner", O.SILVER))
def silver_incremental(spark, sf):
    """Promotion of what bronze has gained: a day with three channels, a day on which the database is snapshotted anew
    and the queue lands one more batch, and a run that finds nothing new; equal to the full promotion."""
    root, bronze = scratch_folder(spark, "silver-incremental"), Feed(spark, sf).partner_bronze()
    first_day = F.col("updated_at") < F.lit(MERGE_CUTOFF).cast("timestamp_ntz")

    def load(channel: str, of, disposition: str) -> None:
        B.write_bronze(bronze.filter((F.col("channel") == channel) & of).select(*PARTNER_COLUMNS), root, channel, "partner_transactions", disposition)

    for channel in ("partner_db", "sftp_drop", "kafka_drain"):
        load(channel, first_day, "append" if channel == "kafka_drain" else "replace")
    back = dt.timedelta(days=LOOKBACK_DAYS)
    promote_incremental(spark, root, "partner_transactions", back, buckets=16)
    for channel in ("partner_db", "sftp_drop"):
        load(channel, F.lit(True), "replace")
    load("kafka_drain", ~first_day, "append")
    second = promote_incremental(spark, root, "partner_transactions", back)
    if sorted(second.loads) != ["kafka_drain", "partner_db", "sftp_drop"] or any(len(v) != 1 for v in second.loads.values()):
        raise AssertionError(f"the second run read {second.loads}; expected one new load a channel")
    if promote_incremental(spark, root, "partner_transactions", back).loads:
        raise AssertionError("a run without new loads read bronze")
    return silver_table(spark, root, "partner_transactions").read()


# --- the daily job ------------------------------------------------------------------------------



@query("pipeline_run", O.on_model(f"""
SELECT * FROM (VALUES ('extract', 'partner_transactions'), ('extract', 'bank_transactions'),
  ('promote', 'partner_transactions'), ('promote', 'bank_transactions'),
  ('build', 'fct_transactions'), ('build', 'fct_transactions_current'), ('build', 'dim_partner'),
  ('build', 'dim_bank'), ('build', 'dim_decline_reason'), ('build', 'dim_date'),
  ('test', 'declared_checks'), ('freshness', 'partner_transactions'), ('freshness', 'bank_transactions')) s(step, table_name)
JOIN (
  SELECT 'extract' AS st, 'partner_transactions' AS tn, CAST(count(*) AS BIGINT) AS rows, 'ok' AS status FROM fx_partner_bronze
  UNION ALL SELECT 'extract', 'bank_transactions', count(*), 'ok' FROM fx_bank_bronze
  UNION ALL SELECT 'promote', 'partner_transactions', count(*), 'ok' FROM silver_partner
  UNION ALL SELECT 'promote', 'bank_transactions', count(*), 'ok' FROM silver_bank
  UNION ALL SELECT 'build', 'fct_transactions', count(*), 'ok' FROM fact
  UNION ALL SELECT 'build', 'fct_transactions_current', count(*), 'ok' FROM current_fact
  UNION ALL SELECT 'build', 'dim_partner', count(*), 'ok' FROM dim_partner
  UNION ALL SELECT 'build', 'dim_bank', count(*), 'ok' FROM dim_bank
  UNION ALL SELECT 'build', 'dim_decline_reason', count(*), 'ok' FROM dim_decline_reason
  UNION ALL SELECT 'build', 'dim_date', count(*), 'ok' FROM dim_date
  UNION ALL SELECT 'test', 'declared_checks', 42, 'ok'
  UNION ALL SELECT 'freshness', 'partner_transactions', 1,
    CASE WHEN (epoch_us(TIMESTAMP '{FRESHNESS_NOW}') - epoch_us(max(updated_at))) / 3.6e9 > 8 THEN 'error'
         WHEN (epoch_us(TIMESTAMP '{FRESHNESS_NOW}') - epoch_us(max(updated_at))) / 3.6e9 > 4 THEN 'warn' ELSE 'pass' END
    FROM silver_partner
  UNION ALL SELECT 'freshness', 'bank_transactions', 1,
    CASE WHEN (epoch_us(TIMESTAMP '{FRESHNESS_NOW}') - epoch_us(max(updated_at))) / 3.6e9 > 8 THEN 'error'
         WHEN (epoch_us(TIMESTAMP '{FRESHNESS_NOW}') - epoch_us(max(updated_at))) / 3.6e9 > 4 THEN 'warn' ELSE 'pass' END
    FROM silver_bank
) r ON s.step = r.st AND s.table_name = r.tn""".replace("SELECT * FROM (VALUES", "SELECT s.step, s.table_name, r.rows, r.status FROM (VALUES")))
def pipeline_run(spark, sf):
    """The whole daily job end to end (four channels, promote, build, test gate,
    freshness) into a fresh folder; one summary row per step and table."""
    return _daily_run(spark, sf)[1]


_daily_runs: dict = {}


def _daily_run(spark, sf) -> tuple[str, DataFrame]:
    """Folder and summary of one daily job per application and state of the input, run on first use."""
    key = (spark.conf.get("spark.app.id", None) or id(spark), sf, fingerprint(spark, f"{sf}/orders.parquet"))
    if key not in _daily_runs:
        root = scratch_folder(spark, "pipeline")
        _daily_runs[key] = root, run_pipeline(spark, sf, root, FRESHNESS_NOW)
    return _daily_runs[key]


@query("pipeline_gold", REVENUE_BY_PARTNER_SQL)
def pipeline_gold(spark, sf):
    """Volume and revenue per partner from the mart that a whole daily job wrote and published."""
    return K.revenue_by_partner(read_gold(spark, _daily_run(spark, sf)[0], "mart_transactions"))
