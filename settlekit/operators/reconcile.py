"""Two-sided reconciliation, fee at capture, and current state per transaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.functions.columns import epoch, fee_at_capture
from settlekit.operators.promote import KEY, VERSION, latest_per_key

PARTNER_KEPT = ("state", "decline_reason", "initiated_at", "authorized_at",
                "captured_at", "settled_at", "failed_at", "refunded_at")
BANK_KEPT = ("state", "decline_reason", "authorized_at", "captured_at", "settled_at", "failed_at")

RECONCILED_COLUMNS = (
    "transaction_id", "partner_id", "amount_cents", "currency",
    *PARTNER_KEPT,
    "bank_id", *[f"bank_{c}" for c in BANK_KEPT], "updated_at",
)
FACT_COLUMNS = (*RECONCILED_COLUMNS, "fee_amount_cents")


def reconcile(partner: DataFrame, bank: DataFrame) -> DataFrame:
    """FULL OUTER equi-join of the partner and bank views on transaction_id.

    Shared identity columns are coalesced partner-first; the partner's
    lifecycle columns are kept as they are, the bank's get a ``bank_`` prefix
    (its refunded_at is not carried); ``updated_at`` is the later of both sides.
    A full outer join cannot broadcast: both sides are hash-partitioned on the
    key, which is the partitioning promotion already produced.
    """
    p, b = partner.alias("p"), bank.alias("b")
    j = p.join(b, F.col("p.transaction_id") == F.col("b.transaction_id"), "full_outer")

    def both(c: str):
        return F.coalesce(F.col(f"p.{c}"), F.col(f"b.{c}")).alias(c)

    return j.select(
        F.coalesce(F.col("p.transaction_id"), F.col("b.transaction_id")).cast("string").alias("transaction_id"),
        both("partner_id"), both("amount_cents"), both("currency"),
        *[F.col(f"p.{c}").alias(c) for c in PARTNER_KEPT],
        both("bank_id"),
        *[F.col(f"b.{c}").alias(f"bank_{c}") for c in BANK_KEPT],
        F.greatest(F.coalesce(F.col("p.updated_at"), epoch()),
                   F.coalesce(F.col("b.updated_at"), epoch())).alias("updated_at"),
    )


def with_fee(reconciled: DataFrame, fee_schedule: DataFrame) -> DataFrame:
    """Fee fact: fee at capture stored on the row, NULL when not captured on either
    side or when no schedule row matches the (partner, bank) pair. The caller marks
    the schedule for broadcast where its size is known."""
    fee = fee_schedule.select("partner_id", "bank_id", "fixed_fee_cents", "percentage_bps")
    r, f = reconciled.alias("r"), fee.alias("f")
    j = r.join(f, (F.col("r.partner_id") == F.col("f.partner_id")) & (F.col("r.bank_id") == F.col("f.bank_id")), "left")
    captured = F.col("r.bank_captured_at").isNotNull() | F.col("r.captured_at").isNotNull()
    fee_cents = F.when(captured, fee_at_capture(F.col("r.amount_cents"), F.col("f.fixed_fee_cents"),
                                                F.col("f.percentage_bps")))
    return j.select(*[F.col(f"r.{c}") for c in RECONCILED_COLUMNS], fee_cents.alias("fee_amount_cents"))


def current_latest_nonnull(fact: DataFrame, key: str = KEY, version: str = VERSION,
                           columns: Sequence[str] | None = None) -> DataFrame:
    """Per key, each column's value from the newest version where it is not NULL
    (argMax semantics: NULL arguments are skipped), plus max(version).

    One aggregation, partial on the map side, so a hot key is pre-reduced in
    every map task (its buffers hold text, so it sorts by key on both sides). Ties on ``version`` pick the greater value.
    """
    cols = [c for c in (columns or fact.columns) if c not in (key, version)]
    aggs = []
    for c in cols:
        ordering = F.when(F.col(c).isNotNull(), F.struct(F.col(version), F.col(c)))
        aggs.append(F.max_by(F.col(c), ordering).alias(c))
    out = fact.groupBy(key).agg(*aggs, F.max(version).alias(version))
    return out.select(key, *cols, version)


def current_latest_row(fact: DataFrame, key: str = KEY, version: str = VERSION) -> DataFrame:
    """Per key, the whole newest row (what a replacing merge converges to)."""
    return latest_per_key(fact, key, version)
