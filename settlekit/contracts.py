"""Column contracts, schemas and the fixed catalog values of the transaction domain.

Everything here is data, not logic: the bronze->silver column lists, the Spark
schemas that go with them, the accepted lifecycle vocabulary, the fee seed and
the channel map. Operators import these instead of re-spelling column names.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results).
# ---------------------------------------------------------------------------

# Business columns of each side in file order; promotion keeps exactly these.
PARTNER_COLUMNS = (
    "transaction_id", "partner_id", "bank_id", "amount_cents", "currency",
    "state", "decline_reason", "initiated_at", "authorized_at",
    "captured_at", "settled_at", "failed_at", "refunded_at", "updated_at",
)
BANK_COLUMNS = (
    "transaction_id", "partner_id", "bank_id", "amount_cents", "currency",
    "state", "decline_reason", "authorized_at", "captured_at",
    "settled_at", "failed_at", "refunded_at", "updated_at",
)

# Transport fields that carry ISO-8601 text and are parsed back to timestamps.
TIMESTAMP_FIELDS = (
    "initiated_at", "authorized_at", "captured_at",
    "settled_at", "failed_at", "refunded_at", "updated_at",
)

# Accepted lifecycle values (NULL passes the accepted-values check).
PARTNER_STATES = ("initiated", "authorized", "captured", "settled", "failed", "refunded")
BANK_STATES = ("authorized", "captured", "settled", "failed", "refunded")
DECLINE_REASONS = ("insufficient_funds", "fraud_suspected", "technical_error", "invalid_account")

# Identifier guard: a standalone run of 13-19 ASCII digits looks like a raw card
# or account number. RE2-compatible form (no look-around), equal as a predicate.
DIGIT_RUN_PATTERN = r"(^|[^0-9])[0-9]{13,19}([^0-9]|$)"

# Fee seed: partner_id, bank_id, fixed_fee_cents, percentage_bps (24 rows).
FEE_SCHEDULE_ROWS = (
    ("partner_acme", "bank_chase", 30, 250),
    ("partner_acme", "bank_wells_fargo", 25, 220),
    ("partner_acme", "bank_citibank", 35, 260),
    ("partner_acme", "bank_goldman", 40, 270),
    ("partner_globex", "bank_chase", 20, 200),
    ("partner_globex", "bank_wells_fargo", 15, 180),
    ("partner_globex", "bank_citibank", 25, 210),
    ("partner_globex", "bank_goldman", 30, 230),
    ("partner_initech", "bank_chase", 40, 300),
    ("partner_initech", "bank_wells_fargo", 35, 280),
    ("partner_initech", "bank_citibank", 45, 310),
    ("partner_initech", "bank_goldman", 50, 320),
    ("partner_umbrella", "bank_chase", 35, 270),
    ("partner_umbrella", "bank_wells_fargo", 30, 250),
    ("partner_umbrella", "bank_citibank", 40, 290),
    ("partner_umbrella", "bank_goldman", 45, 300),
    ("partner_wonka", "bank_chase", 25, 230),
    ("partner_wonka", "bank_wells_fargo", 20, 210),
    ("partner_wonka", "bank_citibank", 30, 240),
    ("partner_wonka", "bank_goldman", 35, 260),
    ("partner_stark", "bank_chase", 15, 190),
    ("partner_stark", "bank_wells_fargo", 10, 170),
    ("partner_stark", "bank_citibank", 20, 200),
    ("partner_stark", "bank_goldman", 25, 220),
)

# Queue topics and the bronze table each one lands in.
TOPIC_TABLES = {
    "partner-transactions": "partner_transactions",
    "bank-transactions": "bank_transactions",
}

# ---------------------------------------------------------------------------
# Spark schemas derived from the contracts.
# ---------------------------------------------------------------------------

_TS = T.TimestampNTZType()


def _field(name: str) -> T.StructField:
    if name in TIMESTAMP_FIELDS:
        return T.StructField(name, _TS, True)
    if name == "amount_cents":
        return T.StructField(name, T.LongType(), True)
    return T.StructField(name, T.StringType(), True)


PARTNER_SCHEMA = T.StructType([_field(c) for c in PARTNER_COLUMNS])
BANK_SCHEMA = T.StructType([_field(c) for c in BANK_COLUMNS])
FEE_SCHEMA = T.StructType([
    T.StructField("partner_id", T.StringType(), False),
    T.StructField("bank_id", T.StringType(), False),
    T.StructField("fixed_fee_cents", T.IntegerType(), False),
    T.StructField("percentage_bps", T.IntegerType(), False),
])

TABLE_COLUMNS = {"partner_transactions": PARTNER_COLUMNS, "bank_transactions": BANK_COLUMNS}
TABLE_SCHEMAS = {"partner_transactions": PARTNER_SCHEMA, "bank_transactions": BANK_SCHEMA}


def text_schema(table: str) -> T.StructType:
    """All-string schema of a table: how CSV drops and queue bodies arrive."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in TABLE_COLUMNS[table]])
