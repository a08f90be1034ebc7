"""Small literal DataFrames for each semantics note of the model."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from settlekit.contracts import BANK_SCHEMA, FEE_SCHEMA, PARTNER_SCHEMA
from settlekit.functions.columns import fee_at_capture, has_digit_run, surrogate_key
from settlekit.operators import dims as D
from settlekit.operators import metrics as K
from settlekit.operators.promote import latest_per_key
from settlekit.operators.reconcile import current_latest_nonnull, current_latest_row, reconcile, with_fee

TS = dt.datetime


def test_argmax_skips_nulls_per_column_but_latest_row_does_not(spark):
    df = spark.createDataFrame(
        [("t1", "initiated", "technical_error", TS(2024, 1, 1)),
         ("t1", "settled", None, TS(2024, 1, 2))],
        "transaction_id string, state string, decline_reason string, updated_at timestamp_ntz")
    cur = current_latest_nonnull(df).first()
    row = current_latest_row(df).first()
    assert cur["state"] == "settled" and cur["decline_reason"] == "technical_error"
    assert row["state"] == "settled" and row["decline_reason"] is None
    assert cur["updated_at"] == TS(2024, 1, 2)


def test_fee_rounds_half_to_even_on_double(spark):
    # 100 * 250 / 10000 = 2.5 -> 2 (half-even); 300 * 250 / 10000 = 7.5 -> 8
    df = spark.createDataFrame([(100, 0, 250), (300, 0, 250), (101, 30, 250)],
                               "amount_cents long, fixed_fee_cents int, percentage_bps int")
    got = [r[0] for r in df.select(fee_at_capture("amount_cents", "fixed_fee_cents", "percentage_bps")).collect()]
    assert got == [2, 8, 33]


def test_fee_is_null_when_not_captured_or_no_schedule_row(spark):
    p = spark.createDataFrame(
        [("a", "p1", "b1", 1000, "USD", "settled", None, TS(2024, 1, 1), TS(2024, 1, 1), TS(2024, 1, 1),
          TS(2024, 1, 1), None, None, TS(2024, 1, 1)),
         ("b", "p1", "b1", 1000, "USD", "failed", "fraud_suspected", TS(2024, 1, 1), None, None, None,
          TS(2024, 1, 1), None, TS(2024, 1, 1)),
         ("c", "p9", "b1", 1000, "USD", "settled", None, TS(2024, 1, 1), TS(2024, 1, 1), TS(2024, 1, 1),
          TS(2024, 1, 1), None, None, TS(2024, 1, 1))],
        "transaction_id string, partner_id string, bank_id string, amount_cents long, currency string, "
        "state string, decline_reason string, initiated_at timestamp_ntz, authorized_at timestamp_ntz, "
        "captured_at timestamp_ntz, settled_at timestamp_ntz, failed_at timestamp_ntz, "
        "refunded_at timestamp_ntz, updated_at timestamp_ntz")
    b = spark.createDataFrame([], "transaction_id string, partner_id string, bank_id string, amount_cents long, "
                              "currency string, state string, decline_reason string, authorized_at timestamp_ntz, "
                              "captured_at timestamp_ntz, settled_at timestamp_ntz, failed_at timestamp_ntz, "
                              "refunded_at timestamp_ntz, updated_at timestamp_ntz")
    fee = spark.createDataFrame([("p1", "b1", 30, 250)], FEE_SCHEMA)
    got = {r["transaction_id"]: r["fee_amount_cents"] for r in with_fee(reconcile(p, b), fee).collect()}
    assert got == {"a": 55, "b": None, "c": None}


def _side(spark, schema, rows):
    """Contract-shaped frame: given (column -> value) dicts, every other column NULL."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def test_reconcile_full_outer_keeps_both_orphans_and_drops_bank_refunded_at(spark):
    p = _side(spark, PARTNER_SCHEMA, [
        dict(transaction_id="t1", partner_id="p1", bank_id="b1", amount_cents=10, updated_at=TS(2024, 1, 1)),
        dict(transaction_id="t2", partner_id="p1", bank_id="b1", amount_cents=20, updated_at=TS(2024, 1, 2))])
    b = _side(spark, BANK_SCHEMA, [
        dict(transaction_id="t2", partner_id="p1", bank_id="b2", amount_cents=99, updated_at=TS(2024, 1, 3),
             refunded_at=TS(2024, 1, 3)),
        dict(transaction_id="t3", partner_id="p2", bank_id="b2", amount_cents=30, updated_at=TS(2024, 1, 4))])
    out = reconcile(p, b)
    r = {x["transaction_id"]: x for x in out.collect()}
    assert set(r) == {"t1", "t2", "t3"}
    assert r["t2"]["amount_cents"] == 20 and r["t2"]["bank_id"] == "b1"      # partner first
    assert r["t2"]["updated_at"] == TS(2024, 1, 3)                              # greatest of both
    assert r["t3"]["partner_id"] == "p2" and r["t3"]["initiated_at"] is None   # bank-only orphan
    assert "bank_refunded_at" not in out.columns


def test_division_by_zero_is_null_and_empty_sum_is_null(spark):
    df = spark.createDataFrame([(None, None, None, None)],
                               "authorized_at timestamp_ntz, initiated_at timestamp_ntz, amount_cents long, "
                               "settled_at timestamp_ntz").withColumn("refunded_at", F.lit(None).cast("timestamp_ntz"))
    r = df.agg(K.metric_auth_rate().alias("a"), K.metric_net_volume().alias("n")).first()
    assert r["a"] is None and r["n"] is None


@pytest.mark.parametrize("text,hit", [
    ("4111111111111111", True), ("card 4111111111111 end", True), ("x1234567890123456789y", True),
    ("12345678901234567890", False), ("123456789012", False), ("txn-149999", False), ("", False)])
def test_digit_run_pattern_matches_standalone_13_to_19_digits(spark, text, hit):
    got = spark.createDataFrame([(text,)], "v string").select(has_digit_run("v")).first()[0]
    duck = duckdb.sql(f"SELECT regexp_matches('{text}', '(^|[^0-9])[0-9]{{13,19}}([^0-9]|$)')").fetchall()[0][0]
    assert got is hit and duck is hit


def test_surrogate_key_equals_duckdb_formula(spark):
    vals = ["partner_acme", "bank_chase", "fraud_suspected"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "v string").select(surrogate_key("v")).collect()]
    want = [duckdb.sql(f"SELECT CAST(('0x' || substr(md5('{v}'), 1, 15)) AS BIGINT)").fetchall()[0][0] for v in vals]
    assert got == want and all(k >= 0 for k in got)


def test_dim_date_calendar_attributes(spark):
    rows = {r["date_day"]: r for r in D.dim_date(spark, "2025-01-01", 1096).collect()}
    assert len(rows) == 1096 and max(rows) == dt.date(2027, 12, 31) + dt.timedelta(days=1)
    d = rows[dt.date(2025, 1, 5)]                      # a Sunday
    assert d["day_of_week"] == 7 and d["is_weekend"] and d["week_start"] == dt.date(2024, 12, 30)
    assert d["iso_week"] == 1 and d["date_key"] == 20250105 and d["quarter"] == 1
    assert rows[dt.date(2025, 12, 29)]["iso_week"] == 1   # ISO week of the next year


def test_latest_per_key_is_deterministic_on_ties(spark):
    df = spark.createDataFrame([("t", "a", TS(2024, 1, 1)), ("t", "b", TS(2024, 1, 1))],
                               "transaction_id string, state string, updated_at timestamp_ntz")
    assert [r["state"] for r in latest_per_key(df).collect()] == ["b"]


def test_zone_free_truncation_and_iso_text(spark):
    from settlekit.functions.columns import iso_text, truncate_ntz
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(TS(1996, 4, 7, 2, 30, 15, 120000),)], "t timestamp_ntz")  # inside a DST gap
        r = df.select(*[truncate_ntz("t", u).alias(u) for u in ("hour", "day", "week", "month", "quarter", "year")],
                      iso_text("t").alias("iso")).first()
        assert r["hour"] == TS(1996, 4, 7, 2) and r["day"] == TS(1996, 4, 7)
        assert r["week"] == TS(1996, 4, 1) and r["month"] == TS(1996, 4, 1)
        assert r["quarter"] == TS(1996, 4, 1) and r["year"] == TS(1996, 1, 1)
        assert r["iso"] == "1996-04-07T02:30:15.12"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
