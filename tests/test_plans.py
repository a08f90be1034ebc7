"""Plan-shape checks: the scale properties the design relies on."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from settlekit.fixtures import Feed
from settlekit.operators import audit as A
from settlekit.operators import metrics as K
from settlekit.operators.joins import bounded_broadcast, measured_bytes
from settlekit.operators.promote import latest_per_key, promote
from settlekit.operators.reconcile import current_latest_nonnull, reconcile
from settlekit.plans.model import Model
from settlekit.sources import bronze as B

from paths import SF_SMALL


def plan(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_promotion_limits_rows_per_key_before_the_shuffle(spark):
    p = plan(promote(Feed(spark, SF_SMALL).partner_bronze(), "partner_transactions"))
    partial = p.index("WindowGroupLimit")
    # reading the plan bottom-up: the last (innermost) WindowGroupLimit is below the Exchange
    inner = p.rindex("WindowGroupLimit")
    assert p.index("Exchange hashpartitioning(transaction_id") < inner and partial < inner
    assert "Partial" in p and "Final" in p


def test_reconciliation_reuses_the_promotion_shuffle(spark):
    f = Feed(spark, SF_SMALL)
    p = plan(reconcile(promote(f.partner_bronze(), "partner_transactions"),
                       promote(f.bank_bronze(), "bank_transactions")))
    assert "SortMergeJoin" in p and "FullOuter" in p
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 2          # one per side, none for the join


def test_scan_prunes_columns_and_pushes_filters(spark):
    m = Model.shared(spark, SF_SMALL)
    p = plan(m.current.filter(F.col("partner_id") == "partner_acme").select("amount_cents"), "formatted")
    assert "PushedFilters: [IsNotNull(partner_id), EqualTo(partner_id,partner_acme)]" in p
    assert re.search(r"ReadSchema: struct<partner_id:string,amount_cents:bigint>", p)


def test_charts_broadcast_dimensions_and_shuffle_only_for_the_final_aggregate(spark):
    from settlekit.operators import metrics as K
    p = plan(K.revenue_by_partner(Model.shared(spark, SF_SMALL).mart))
    assert p.count("BroadcastHashJoin") == 4
    assert "SortMergeJoin" not in p


def test_broadcast_only_under_the_measured_bound(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    base = spark.range(100).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(base.join(bounded_broadcast(small, max_bytes=4_000), "k"))
        assert "BroadcastHashJoin" not in plan(base.join(bounded_broadcast(big, max_bytes=4_000), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_with_a_third_of_rows_is_reduced_correctly(spark):
    # 30k rows; key 'hot' holds 10k versions, the rest are unique.
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
         .alias("transaction_id"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("state"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("updated_at"))
    latest = {r["transaction_id"]: r for r in latest_per_key(df).collect()}
    assert len(latest) == 20001 and latest["hot"]["state"] == "29997"
    cur = {r["transaction_id"]: r for r in current_latest_nonnull(df).collect()}
    assert cur["hot"]["state"] == "29997" and cur["hot"]["updated_at"] == latest["hot"]["updated_at"]
    assert "partial_max_by" in plan(current_latest_nonnull(df))


def test_current_state_of_a_single_version_fact_is_the_fact(spark):
    m = Model(spark, SF_SMALL)
    cols = sorted(m.fact.columns)
    assert m.current is not m.fact and cols == sorted(m.current.columns)
    assert m.fact.select(*cols).exceptAll(m.current.select(*cols)).count() == 0
    assert m.current.select(*cols).exceptAll(m.fact.select(*cols)).count() == 0


def test_day_chart_is_not_truncated(spark):
    mart = spark.range(10_050).select(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp_ntz").alias("initiated_at"))
    row = A.chart_total_audit(K.volume_by_day(mart), "count", mart).first()
    assert (row["chart_total"], row["fact_total"], row["matches"]) == (10_050, 10_050, True)
    assert K.chart_query(mart, {"count": K.count_rows()}, x_axis="initiated_at", row_limit=7).count() == 7


def test_broadcast_is_bounded_by_bytes(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 10_000).alias("t"))
    assert measured_bytes(wide) > 1_000_000
    assert "broadcast" in bounded_broadcast(wide)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in bounded_broadcast(wide, max_bytes=900_000)._jdf.queryExecution().logical().toString()


def test_buckets_follow_the_bytes():
    assert [B.buckets_for_bytes(n) for n in (0, 1, 256 << 20, (256 << 20) + 1, 100 << 40)] == [1, 1, 1, 2, 524_288]


def test_bucketed_silver_reconciles_without_a_shuffle(spark):
    m = Model(spark, SF_SMALL)
    p = plan(reconcile(m.partner_silver, m.bank_silver))
    assert "SortMergeJoin" in p and "FullOuter" in p and "Exchange" not in p


def test_bucketed_fact_gives_the_current_state_and_uniqueness_without_a_shuffle(spark):
    from settlekit.operators import quality as Q
    from settlekit.plans import suite as S

    m = Model(spark, SF_SMALL)
    p = plan(current_latest_nonnull(m.fact))
    assert "Exchange" not in p and p.count("Sort [") == 1       # one sort of rows that lie sorted
    for name in ("stg_partner_transactions", "int_reconciled_transactions", "fct_transactions_current"):
        assert "Exchange" not in plan(Q.unique(S.model_tables(m)[name], "transaction_id"))
    p = plan(S.declared_suite(m))
    assert not re.search(r"Exchange hashpartitioning\(transaction_id", p)
    # no transaction id goes through the one aggregation by (check, value)
    assert "transaction_id" not in "".join(re.findall(r"Exchange hashpartitioning.*", p))


def test_uniqueness_inside_buckets_counts_what_the_plain_form_counts(spark):
    from settlekit.operators import quality as Q

    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2), ("c", 3), ("c", 3), ("c", 4)], "id string, v int")
    specs = [Q.ModelChecks("t", [Q.Check("unique", "id"), Q.Check("unique", "v"), Q.Check("not_null", "id")])]
    found = [sorted(map(tuple, Q.run_checks({"t": rows}, specs, by).collect())) for by in (None, {"t": "id"})]
    assert found[0] == found[1] and [r[3] for r in found[0]] == [2, 2, 3]
    only = [Q.ModelChecks("t", [Q.Check("unique", "id")])]
    assert [r["failures"] for r in Q.run_checks({"t": rows}, only, {"t": "id"}).collect()] == [2]


def test_buckets_grow_with_the_transactions(spark, monkeypatch):
    from settlekit.plans import model

    own = spark.conf.get("spark.sql.shuffle.partitions")
    assert [B.buckets_for_rows(spark, n) for n in (0, 1, 54_000_000)] == [int(own), int(own), 256]
    monkeypatch.setattr(model, "buckets_for_rows", lambda s, rows: B.buckets_for_rows(s, rows, bucket_rows=50))
    m = Model(spark, SF_SMALL)
    rows = m.feed.orders.count()
    for table in (m.partner_silver, m.fact, m.current):
        files = {f.rsplit("_", 1)[1].split(".")[0] for f in table.inputFiles()}
        assert len(files) > int(own) and table.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] < rows / int(own) / 2
    assert "Exchange" not in plan(current_latest_nonnull(m.fact)) and spark.conf.get("spark.sql.shuffle.partitions") == own
    plain = Model(spark, SF_SMALL, materialized=False).current
    assert m.current.exceptAll(plain).isEmpty() and plain.exceptAll(m.current).isEmpty()
