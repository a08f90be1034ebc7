"""Golden numbers of the sf0.01 fixture: the feed exercises every anomaly the
reconciliation must handle (both orphan kinds, re-deliveries, refunds, all
partner x bank pairs), and the reference's invariant checks hold on it."""

from pyspark.sql import functions as F

from settlekit import fixtures as fx
from settlekit.operators import audit as A
from settlekit.operators import quality as Q
from settlekit.plans.model import Model

SF = "/root/testdata/sf0.01"


def test_fixture_is_not_vacuous_and_invariants_hold(spark):
    m = Model.shared(spark, SF)
    r = A.reconciliation_audit(m.current).first()
    assert r["total_rows"] == 15000 and r["duplicate_transaction_ids"] == 0
    assert r["partner_only_rows"] == 761 and r["bank_only_rows"] == 776
    assert r["captured_without_fee"] == 0 and r["rows_with_fee"] > 0
    assert Q.unique(m.feed.partner_bronze(), "transaction_id").count() == 182
    assert fx.outcome(m.feed.orders).filter(F.col("state") == "refunded").count() == 508
    cov = A.fee_coverage_audit(m.current, m.fee_schedule).first()
    assert (cov["pairs"], cov["missing_pairs"]) == (24, 0)
    cat = A.catalog_audit(m.current).first()
    assert (cat["partners"], cat["banks"]) == (6, 4) and cat["distinct_days"] >= 44
    assert A.rate_spread_audit(m.current).first()["rate_spread"] >= 0.07
    assert A.join_integrity(m.partner_silver, m.bank_silver).first()["integrity_ok"]
