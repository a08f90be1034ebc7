"""DuckDB SQL for every registered query: the independent oracle.

Each query is the fixture CTEs (``settlekit.fixtures.DUCKDB_CTES``) plus the
model CTEs below (silver, reconciled, fact, current, dimensions, mart) plus a
final SELECT. Casts make DuckDB's result types equal Spark's (HUGEINT sums,
BIGINT calendar parts, TIMESTAMP date_trunc of DATE).
"""

from __future__ import annotations

import re

from settlekit.contracts import BANK_COLUMNS, PARTNER_COLUMNS
from settlekit.fixtures import with_fixture

# Columns of the model, written out here so that the oracle does not follow the operators.
PARTNER_KEPT = ("state", "decline_reason", "initiated_at", "authorized_at", "captured_at", "settled_at", "failed_at", "refunded_at")
BANK_KEPT = ("state", "decline_reason", "authorized_at", "captured_at", "settled_at", "failed_at")
FACT_COLUMNS = (
    "transaction_id", "partner_id", "amount_cents", "currency", "state", "decline_reason", "initiated_at", "authorized_at",
    "captured_at", "settled_at", "failed_at", "refunded_at", "bank_id", "bank_state", "bank_decline_reason",
    "bank_authorized_at", "bank_captured_at", "bank_settled_at", "bank_failed_at", "updated_at", "fee_amount_cents")


def _order_latest(cols) -> str:
    rest = [c for c in cols if c not in ("transaction_id", "updated_at")]
    return ", ".join(["updated_at DESC NULLS LAST", *[f"{c} DESC NULLS LAST" for c in rest]])


def latest_sql(source: str, cols) -> str:
    collist = ", ".join(cols)
    return (f"SELECT {collist} FROM (SELECT {collist}, row_number() OVER (PARTITION BY transaction_id "
            f"ORDER BY {_order_latest(cols)}) AS rn FROM {source}) WHERE rn = 1")


def surrogate(col: str) -> str:
    return f"CAST(('0x' || substr(md5({col}), 1, 15)) AS BIGINT)"


SILVER = f"""
silver_partner AS ({latest_sql('fx_partner_bronze', PARTNER_COLUMNS)}),
silver_bank AS ({latest_sql('fx_bank_bronze', BANK_COLUMNS)})
"""

RECONCILED = """
reconciled AS (
  SELECT CAST(coalesce(p.transaction_id, b.transaction_id) AS VARCHAR) AS transaction_id,
    coalesce(p.partner_id, b.partner_id) AS partner_id,
    coalesce(p.amount_cents, b.amount_cents) AS amount_cents,
    coalesce(p.currency, b.currency) AS currency,
    {partner},
    coalesce(p.bank_id, b.bank_id) AS bank_id,
    {bank},
    greatest(coalesce(p.updated_at, TIMESTAMP '1970-01-01 00:00:00'),
             coalesce(b.updated_at, TIMESTAMP '1970-01-01 00:00:00')) AS updated_at
  FROM silver_partner p FULL OUTER JOIN silver_bank b ON p.transaction_id = b.transaction_id)
""".format(partner=", ".join(f"p.{c}" for c in PARTNER_KEPT),
           bank=", ".join(f"b.{c} AS bank_{c}" for c in BANK_KEPT))

FACT = """
fact AS (
  SELECT r.*,
    CASE WHEN r.bank_captured_at IS NOT NULL OR r.captured_at IS NOT NULL
         THEN f.fixed_fee_cents + CAST(round_even(r.amount_cents * f.percentage_bps / CAST(10000.0 AS DOUBLE), 0) AS BIGINT)
    END AS fee_amount_cents
  FROM reconciled r LEFT JOIN fee_schedule f ON r.partner_id = f.partner_id AND r.bank_id = f.bank_id)
"""


def current_sql(source: str, cols) -> str:
    parts = [f"arg_max({c}, updated_at) FILTER (WHERE {c} IS NOT NULL) AS {c}"
             for c in cols if c not in ("transaction_id", "updated_at")]
    return (f"SELECT transaction_id, {', '.join(parts)}, max(updated_at) AS updated_at "
            f"FROM {source} GROUP BY transaction_id")


def greatest_value_sql(source: str, cols) -> str:
    """As ``current_sql``, but of several values with the newest version the greatest."""
    parts = [f"(max(struct_pack(v := updated_at, c := {c})) FILTER (WHERE {c} IS NOT NULL)).c AS {c}"
             for c in cols if c not in ("transaction_id", "updated_at")]
    return (f"SELECT transaction_id, {', '.join(parts)}, max(updated_at) AS updated_at "
            f"FROM {source} GROUP BY transaction_id")


CURRENT = f"current_fact AS ({current_sql('fact', FACT_COLUMNS)})"


def calendar_sql(days: str) -> str:
    return f"""SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS date_day,
    CAST(isodow(d) AS INTEGER) AS day_of_week, isodow(d) >= 6 AS is_weekend,
    CAST(date_trunc('week', d) AS DATE) AS week_start, CAST(week(d) AS INTEGER) AS iso_week,
    CAST(date_trunc('month', d) AS DATE) AS month_start, CAST(month(d) AS INTEGER) AS month,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year
  FROM ({days})"""


DIMS = f"""
dim_partner AS (SELECT {surrogate('partner_id')} AS partner_key, partner_id
  FROM (SELECT DISTINCT partner_id FROM reconciled WHERE partner_id IS NOT NULL)),
dim_bank AS (SELECT {surrogate('bank_id')} AS bank_key, bank_id
  FROM (SELECT DISTINCT bank_id FROM reconciled WHERE bank_id IS NOT NULL)),
dim_decline_reason AS (SELECT {surrogate('decline_reason')} AS decline_reason_key, decline_reason FROM (
  SELECT decline_reason FROM reconciled WHERE decline_reason IS NOT NULL
  UNION
  SELECT bank_decline_reason FROM reconciled WHERE bank_decline_reason IS NOT NULL)),
date_bounds AS (SELECT CAST(date_trunc('year', min(dday)) AS DATE) AS lo,
    CAST(date_trunc('year', max(dday)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS hi
  FROM (SELECT CAST(coalesce(initiated_at, updated_at) AS DATE) AS dday FROM reconciled)),
dim_date AS ({calendar_sql("SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM date_bounds")})
"""

MART = """
mart AS (
  SELECT f.*, d.date_key, d.week_start, d.month_start, d.quarter, d.year,
    p.partner_key, b.bank_key, r.decline_reason_key,
    coalesce(f.decline_reason, f.bank_decline_reason) AS effective_decline_reason
  FROM current_fact f
  LEFT JOIN dim_date d ON CAST(coalesce(f.initiated_at, f.updated_at) AS DATE) = d.date_day
  LEFT JOIN dim_partner p ON f.partner_id = p.partner_id
  LEFT JOIN dim_bank b ON f.bank_id = b.bank_id
  LEFT JOIN dim_decline_reason r ON coalesce(f.decline_reason, f.bank_decline_reason) = r.decline_reason)
"""

MODEL_CTES = (SILVER, RECONCILED, FACT, CURRENT, DIMS, MART)


def on_model(body: str, *extra: str) -> str:
    """Oracle query over the full model (fixture + silver ... mart)."""
    return with_fixture(body, *MODEL_CTES, *extra)


#: When the earlier of the two versions of the fact was built.
EARLIER = "1998-01-01 00:00:00"


def _renamed(cte: str) -> str:
    for name in ("silver_partner", "silver_bank", "reconciled", "fact"):
        cte = re.sub(rf"\b{name}\b", f"earlier_{name}", cte)
    return cte


EARLIER_FACT = ",\n".join([
    f"earlier_silver_partner AS ({latest_sql(f'(SELECT * FROM fx_partner_bronze WHERE updated_at < TIMESTAMP {EARLIER!r})', PARTNER_COLUMNS)})",
    f"earlier_silver_bank AS ({latest_sql(f'(SELECT * FROM fx_bank_bronze WHERE updated_at < TIMESTAMP {EARLIER!r})', BANK_COLUMNS)})",
    _renamed(RECONCILED), _renamed(FACT),
    "fact_versions AS (SELECT * FROM earlier_fact UNION ALL SELECT * FROM fact)"])

# KPI expressions (DuckDB spelling of settlekit.operators.metrics).
SETTLED = "settled_at IS NOT NULL AND refunded_at IS NULL"
GROSS_VOLUME = "CAST(sum(amount_cents) AS DOUBLE) / 100.0"
NET_VOLUME = f"CAST(sum(CASE WHEN {SETTLED} THEN amount_cents END) AS DOUBLE) / 100.0"
GROSS_REVENUE = "CAST(sum(fee_amount_cents) AS DOUBLE) / 100.0"
NET_REVENUE = f"CAST(sum(CASE WHEN {SETTLED} THEN fee_amount_cents END) AS DOUBLE) / 100.0"


def rate(num: str, den: str) -> str:
    return (f"round(CAST(count_if({num}) AS DOUBLE) / nullif(count_if({den}), 0) * 100, 6)")


AUTH_RATE = rate("authorized_at IS NOT NULL", "initiated_at IS NOT NULL")
SETTLEMENT_RATE = rate("settled_at IS NOT NULL", "authorized_at IS NOT NULL")
