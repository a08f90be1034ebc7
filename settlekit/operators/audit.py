"""Invariant audits over the reconciled model. Each audit is a small number of
aggregations (map-side partial, one row or a few rows out); none collects
rows to the driver and none uses a cross join: several independent counts are
combined by tagging rows and aggregating once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settlekit.operators.joins import bounded_broadcast


def _n(cond: Column) -> Column:
    return F.count_if(cond)


def reconciliation_audit(current: DataFrame) -> DataFrame:
    """Totals, duplicate ids, one-sided rows, captured-without-fee, rows with fee."""
    captured = F.col("captured_at").isNotNull() | F.col("bank_captured_at").isNotNull()
    return current.agg(
        F.count(F.lit(1)).alias("total_rows"),
        (F.count(F.lit(1)) - F.countDistinct("transaction_id")).alias("duplicate_transaction_ids"),
        _n(F.col("initiated_at").isNull() & F.col("bank_id").isNotNull()).alias("bank_only_rows"),
        _n(F.col("initiated_at").isNotNull() & F.col("bank_state").isNull()).alias("partner_only_rows"),
        _n(captured & F.col("fee_amount_cents").isNull()).alias("captured_without_fee"),
        _n(F.col("fee_amount_cents").isNotNull()).alias("rows_with_fee"),
    )


def catalog_audit(current: DataFrame) -> DataFrame:
    """Distinct activity days, partners and banks present."""
    return current.agg(
        F.countDistinct(F.to_date("initiated_at")).alias("distinct_days"),
        F.countDistinct("partner_id").alias("partners"),
        F.countDistinct("bank_id").alias("banks"),
    )


def rate_spread_audit(current: DataFrame) -> DataFrame:
    """D3: per partner, share of rows not failed on either side; spread = max - min.
    A NULL state compares as not-true (bank-only / partner-only rows)."""
    ok = (F.col("state") != "failed") | (F.col("bank_state") != "failed")
    per_partner = current.groupBy("partner_id").agg(
        F.try_divide(F.count_if(ok), F.count(F.lit(1))).alias("rate"))
    return per_partner.agg(
        F.count(F.lit(1)).alias("partners"),
        F.round(F.min("rate"), 6).alias("min_rate"), F.round(F.max("rate"), 6).alias("max_rate"),
        F.round(F.max("rate") - F.min("rate"), 3).alias("rate_spread"))


def fee_coverage_audit(current: DataFrame, fee_schedule: DataFrame) -> DataFrame:
    """Observed (partner, bank) pairs without a usable fee row (missing or 0)."""
    pairs = current.select("partner_id", "bank_id").distinct()
    fee = fee_schedule.select("partner_id", "bank_id", "fixed_fee_cents")
    j = pairs.join(bounded_broadcast(fee), ["partner_id", "bank_id"], "left")
    return j.agg(F.count(F.lit(1)).alias("pairs"),
                 _n(F.col("fixed_fee_cents").isNull() | (F.col("fixed_fee_cents") == 0)).alias("missing_pairs"))


def orphans_except(partner: DataFrame, bank: DataFrame) -> DataFrame:
    """Ids only one side reported, via EXCEPT both ways, glued with UNION ALL."""
    # DISTINCT first: partial aggregation collapses a hot id in every map task
    # before the anti-join's shuffle.
    p, b = partner.select("transaction_id").distinct(), bank.select("transaction_id").distinct()
    p_only = p.subtract(b).agg(F.count(F.lit(1)).alias("orphans")).select(F.lit("partner_only").alias("side"), "orphans")
    b_only = b.subtract(p).agg(F.count(F.lit(1)).alias("orphans")).select(F.lit("bank_only").alias("side"), "orphans")
    return p_only.unionByName(b_only)


def _membership(side: DataFrame, other: DataFrame) -> DataFrame:
    """side rows + flag m: the id occurs in ``other`` (IN-subquery as a left join
    against the other side's distinct ids)."""
    ids = other.select("transaction_id").distinct().withColumn("m", F.lit(True))
    return side.join(ids, "transaction_id", "left").withColumn("m", F.coalesce("m", F.lit(False)))


def match_baseline(partner: DataFrame, bank: DataFrame) -> DataFrame:
    """Per side, rows, duplicate ids and ids also present on the other side
    (with non-NULL bank_id / decline_reason); both directions must agree."""
    def one(side_name: str, side: DataFrame, other: DataFrame) -> DataFrame:
        f = _membership(side.select("transaction_id", "bank_id", "decline_reason"), other)
        return f.agg(
            F.count(F.lit(1)).alias("rows"),
            (F.count(F.lit(1)) - F.countDistinct("transaction_id")).alias("duplicate_ids"),
            _n(F.col("m")).alias("matched_ids"),
            _n(F.col("m") & F.col("bank_id").isNotNull()).alias("matched_nonnull_bank_id"),
            _n(F.col("m") & F.col("decline_reason").isNotNull()).alias("matched_nonnull_decline_reason"),
        ).select(F.lit(side_name).alias("side"), "*")
    return one("partner", partner, bank).unionByName(one("bank", bank, partner))


def join_integrity(partner: DataFrame, bank: DataFrame) -> DataFrame:
    """The full outer join keeps every row and every non-NULL value.

    Join-side counts and single-table baselines are computed from one union of
    tagged rows and ONE aggregation: total = P + B - matched, and each checked
    column keeps as many non-NULL values among matched rows as the baseline.
    """
    p = partner.select("transaction_id", "bank_id", "decline_reason")
    b = bank.select("transaction_id", "bank_id", "decline_reason")
    j = p.alias("p").join(b.alias("b"), F.col("p.transaction_id") == F.col("b.transaction_id"), "full_outer")
    matched = F.col("p.transaction_id").isNotNull() & F.col("b.transaction_id").isNotNull()

    def tag(src: str, df: DataFrame, m: Column, pb: Column, bb: Column, pr: Column, br: Column) -> DataFrame:
        return df.select(F.lit(src).alias("src"), m.alias("m"), pb.alias("pb"), bb.alias("bb"),
                         pr.alias("pr"), br.alias("br"))

    nn = lambda c: F.col(c).isNotNull()
    f = F.lit(False)
    pm = _membership(p, b)
    bm = _membership(b, p)
    rows = (tag("join", j, matched, matched & nn("p.bank_id"), matched & nn("b.bank_id"),
                matched & nn("p.decline_reason"), matched & nn("b.decline_reason"))
            .unionByName(tag("partner", pm, F.col("m"), F.col("m") & nn("bank_id"), f,
                             F.col("m") & nn("decline_reason"), f))
            .unionByName(tag("bank", bm, F.col("m"), f, F.col("m") & nn("bank_id"),
                             f, F.col("m") & nn("decline_reason"))))
    src = F.col("src")
    out = rows.agg(
        _n(src == "join").alias("total_rows"),
        _n((src == "join") & F.col("m")).alias("matched_rows"),
        (_n(src == "partner") + _n(src == "bank") - _n((src == "partner") & F.col("m"))).alias("expected_total_rows"),
        _n((src == "join") & F.col("pb")).alias("matched_nonnull_p_bank_id"),
        _n((src == "partner") & F.col("pb")).alias("expected_nonnull_p_bank_id"),
        _n((src == "join") & F.col("bb")).alias("matched_nonnull_b_bank_id"),
        _n((src == "bank") & F.col("bb")).alias("expected_nonnull_b_bank_id"),
        _n((src == "join") & F.col("pr")).alias("matched_nonnull_decline_reason"),
        _n((src == "partner") & F.col("pr")).alias("expected_nonnull_decline_reason"),
        _n((src == "join") & F.col("br")).alias("matched_nonnull_bank_decline_reason"),
        _n((src == "bank") & F.col("br")).alias("expected_nonnull_bank_decline_reason"),
    )
    ok = ((F.col("total_rows") == F.col("expected_total_rows"))
          & (F.col("matched_nonnull_p_bank_id") == F.col("expected_nonnull_p_bank_id"))
          & (F.col("matched_nonnull_b_bank_id") == F.col("expected_nonnull_b_bank_id"))
          & (F.col("matched_nonnull_decline_reason") == F.col("expected_nonnull_decline_reason"))
          & (F.col("matched_nonnull_bank_decline_reason") == F.col("expected_nonnull_bank_decline_reason")))
    return out.withColumn("integrity_ok", ok)


def null_keys_audit(tables: dict[str, DataFrame], key: str = "transaction_id", state: str = "state") -> DataFrame:
    """Per table, row count and rows with a NULL id or state (table must not be empty)."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows"),
                     _n(F.col(key).isNull() | F.col(state).isNull()).alias("null_key_rows"))
        one = one.select(F.lit(name).alias("table_name"), "rows", "null_key_rows",
                         ((F.col("rows") > 0) & (F.col("null_key_rows") == 0)).alias("ok"))
        out = one if out is None else out.unionByName(one)
    return out


def chart_total_audit(chart: DataFrame, count_col: str, current: DataFrame) -> DataFrame:
    """The day chart's counts sum to the fact's row count."""
    rows = (chart.select(F.lit("chart").alias("src"), F.col(count_col).cast("bigint").alias("n"))
                 .unionByName(current.select(F.lit("fact").alias("src"), F.lit(1).cast("bigint").alias("n"))))
    out = rows.agg(F.sum(F.when(F.col("src") == "chart", F.col("n"))).alias("chart_total"),
                   F.sum(F.when(F.col("src") == "fact", F.col("n"))).alias("fact_total"))
    return out.withColumn("matches", F.col("chart_total") == F.col("fact_total"))


def channel_coverage_audit(bronze: dict[str, DataFrame], min_channels: int = 2) -> DataFrame:
    """Rows per (table, channel) and whether each table arrived by enough channels."""
    out = None
    for table, df in bronze.items():
        one = df.groupBy("channel").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(table).alias("table_name"), "channel", "rows")
        out = one if out is None else out.unionByName(one)
    w = Window.partitionBy("table_name")
    return out.withColumn("table_channels", F.count(F.lit(1)).over(w)).withColumn(
        "ok", F.col("table_channels") >= min_channels)

