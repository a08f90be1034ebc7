"""The declared data tests of the model (42), as check specs over named models."""

from __future__ import annotations

from pyspark.sql import DataFrame

from settlekit.contracts import BANK_STATES, DECLINE_REASONS, PARTNER_STATES
from settlekit.operators.quality import Check, ModelChecks, run_checks
from settlekit.plans.model import Model, materialize

# Which test applies to which model column.
DECLARED = [
    ModelChecks("stg_partner_transactions", [
        Check("not_null", "transaction_id"), Check("unique", "transaction_id"),
        Check("no_digit_run", "transaction_id"),
        Check("not_null", "partner_id"), Check("no_digit_run", "partner_id"),
        Check("not_null", "state"), Check("accepted_values", "state", PARTNER_STATES),
        Check("accepted_values", "decline_reason", DECLINE_REASONS),
    ]),
    ModelChecks("stg_bank_transactions", [
        Check("not_null", "transaction_id"), Check("unique", "transaction_id"),
        Check("no_digit_run", "transaction_id"),
        Check("not_null", "bank_id"), Check("no_digit_run", "bank_id"),
        Check("not_null", "state"), Check("accepted_values", "state", BANK_STATES),
        Check("accepted_values", "decline_reason", DECLINE_REASONS),
    ]),
    ModelChecks("int_reconciled_transactions", [
        Check("not_null", "transaction_id"), Check("unique", "transaction_id"),
    ]),
    ModelChecks("dim_partner", [Check("not_null", "partner_key"), Check("unique", "partner_key"),
                                Check("not_null", "partner_id"), Check("unique", "partner_id")]),
    ModelChecks("dim_bank", [Check("not_null", "bank_key"), Check("unique", "bank_key"),
                             Check("not_null", "bank_id"), Check("unique", "bank_id")]),
    ModelChecks("dim_decline_reason", [Check("not_null", "decline_reason_key"), Check("unique", "decline_reason_key"),
                                       Check("not_null", "decline_reason"), Check("unique", "decline_reason")]),
    ModelChecks("dim_date", [Check("not_null", "date_key"), Check("unique", "date_key"),
                             Check("not_null", "date_day"), Check("unique", "date_day")]),
    ModelChecks("fct_transactions_current", [Check("not_null", "transaction_id"), Check("unique", "transaction_id")]),
    ModelChecks("mart_transactions", [
        Check("not_null", "transaction_id"), Check("unique", "transaction_id"),
        Check("relationships", "partner_key", parent="dim_partner", parent_field="partner_key"),
        Check("relationships", "bank_key", parent="dim_bank", parent_field="bank_key"),
        Check("relationships", "decline_reason_key", parent="dim_decline_reason", parent_field="decline_reason_key"),
        Check("relationships", "date_key", parent="dim_date", parent_field="date_key"),
    ]),
]


def model_tables(m: Model, partner_silver: DataFrame | None = None) -> dict[str, DataFrame]:
    return {
        "stg_partner_transactions": partner_silver if partner_silver is not None else m.partner_silver,
        "stg_bank_transactions": m.bank_silver,
        "int_reconciled_transactions": m.reconciled,
        "dim_partner": m.dim_partner, "dim_bank": m.dim_bank,
        "dim_decline_reason": m.dim_decline_reason, "dim_date": m.dim_date,
        "fct_transactions_current": m.current, "mart_transactions": m.mart,
    }


#: Models that are stored bucketed by the transaction (the mart: its current state is).
STORED_BY = {name: "transaction_id" for name in ("stg_partner_transactions", "stg_bank_transactions", "int_reconciled_transactions",
                                                 "fct_transactions_current", "mart_transactions")}


def declared_suite(m: Model) -> DataFrame:
    return run_checks(model_tables(m), DECLARED, STORED_BY)


def suite_results(m: Model) -> DataFrame:
    """The declared suite's results, written once per model (a row per declared check)."""
    if m.suite is None:
        m.suite = materialize(declared_suite(m), "declared_checks")
    return m.suite


# DuckDB oracle of each check kind (same semantics, written independently).
def check_sql(model: str, c: Check) -> str:
    if c.kind == "not_null":
        q = f"SELECT count(*) FROM {model} WHERE {c.column} IS NULL"
    elif c.kind == "unique":
        q = (f"SELECT count(*) FROM (SELECT {c.column} FROM {model} WHERE {c.column} IS NOT NULL "
             f"GROUP BY {c.column} HAVING count(*) > 1)")
    elif c.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in c.values)
        q = f"SELECT count(*) FROM {model} WHERE {c.column} IS NOT NULL AND {c.column} NOT IN ({vals})"
    elif c.kind == "no_digit_run":
        q = (f"SELECT count(*) FROM {model} WHERE regexp_matches(CAST({c.column} AS VARCHAR), "
             r"'(^|[^0-9])[0-9]{13,19}([^0-9]|$)')")
    elif c.kind == "relationships":
        q = (f"SELECT count(*) FROM {model} ch WHERE ch.{c.column} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {c.parent} pa WHERE pa.{c.parent_field} = ch.{c.column})")
    else:
        raise ValueError(c.kind)
    status = (f"CASE WHEN ({q}) = 0 THEN 'pass' WHEN '{c.severity}' = 'warn' THEN 'warn' ELSE 'fail' END")
    return (f"SELECT '{model}' AS model, '{c.column}' AS column_name, '{c.kind}' AS test, "
            f"CAST(({q}) AS BIGINT) AS failures, '{c.severity}' AS severity, {status} AS status")


ORACLE_MODEL_NAMES = {
    "stg_partner_transactions": "silver_partner", "stg_bank_transactions": "silver_bank",
    "int_reconciled_transactions": "reconciled", "fct_transactions_current": "current_fact",
    "mart_transactions": "mart",
}


def suite_sql(specs=DECLARED) -> str:
    parts = []
    for spec in specs:
        for c in spec.checks:
            name = ORACLE_MODEL_NAMES.get(spec.name, spec.name)
            q = check_sql(name, c).replace(f"'{name}' AS model", f"'{spec.name}' AS model")
            parts.append(q)
    return "\nUNION ALL\n".join(parts)
