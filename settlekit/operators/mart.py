"""Star mart: current fact joined to the four conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.operators.dims import activity_day
from settlekit.operators.joins import bounded_broadcast
from settlekit.operators.reconcile import FACT_COLUMNS

MART_EXTRA = ("date_key", "week_start", "month_start", "quarter", "year",
              "partner_key", "bank_key", "decline_reason_key", "effective_decline_reason")
MART_COLUMNS = (*FACT_COLUMNS, *MART_EXTRA)


def mart(current: DataFrame, dim_date: DataFrame, dim_partner: DataFrame,
         dim_bank: DataFrame, dim_decline_reason: DataFrame, checked: bool = False) -> DataFrame:
    """LEFT JOIN the current fact to every dimension (unmatched keys stay NULL).

    Two join keys are expressions: the calendar day of
    coalesce(initiated_at, updated_at) (bank-only rows have no initiated_at)
    and the effective decline reason coalesce(partner, bank). Dimensions are
    broadcast once their row count is measured to be small (``checked=True``:
    the caller already measured and marked them).
    """
    bb = (lambda df: df) if checked else bounded_broadcast
    f = current.select(*FACT_COLUMNS,
                       activity_day(current).alias("_day"),
                       F.coalesce("decline_reason", "bank_decline_reason").alias("effective_decline_reason"))
    d = bb(dim_date.select(F.col("date_day").alias("_day"), "date_key", "week_start",
                                          "month_start", "quarter", "year"))
    p = bb(dim_partner.select(F.col("partner_id").alias("_pid"), "partner_key"))
    b = bb(dim_bank.select(F.col("bank_id").alias("_bid"), "bank_key"))
    r = bb(dim_decline_reason.select(F.col("decline_reason").alias("_reason"),
                                                    "decline_reason_key"))
    out = (f.join(d, "_day", "left")
            .join(p, F.col("partner_id") == F.col("_pid"), "left")
            .join(b, F.col("bank_id") == F.col("_bid"), "left")
            .join(r, F.col("effective_decline_reason") == F.col("_reason"), "left"))
    return out.select(*MART_COLUMNS)
