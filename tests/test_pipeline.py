"""The daily job end to end, a safe full re-run, and the test gate."""

import pytest
from pyspark.sql import functions as F

from settlekit.plans.pipeline import DailyPipeline, PipelineFailed, read_gold, run_pipeline

from paths import SF_SMALL

NOW = "2001-08-03 06:00:00"


def _summary(df):
    return {(r["step"], r["table_name"]): (r["rows"], r["status"]) for r in df.collect()}


def test_rerun_into_the_same_folder_gives_the_same_tables(spark, tmp_dir):
    first = _summary(run_pipeline(spark, SF_SMALL, tmp_dir, NOW))
    second = _summary(run_pipeline(spark, SF_SMALL, tmp_dir, NOW))
    for step in ("promote", "build", "test", "freshness"):
        assert {k: v for k, v in first.items() if k[0] == step} == {k: v for k, v in second.items() if k[0] == step}
    assert first[("test", "declared_checks")] == (42, "ok")
    silver = spark.read.parquet(f"{tmp_dir}/silver/partner_transactions")
    assert silver.count() == silver.select("transaction_id").distinct().count()


def test_failed_gate_stops_the_job(spark, tmp_dir):
    p = DailyPipeline(spark, SF_SMALL, tmp_dir, NOW)
    p.extract_db("partner_transactions")
    p.extract_db("bank_transactions")
    silver = {t: spark.read.parquet(f"{tmp_dir}/bronze/{ch}/{t}").drop("channel")
              for t, ch in (("partner_transactions", "partner_db"), ("bank_transactions", "bank_db"))}
    # duplicate every partner row: the unique test on staging must fail the gate
    silver["partner_transactions"] = silver["partner_transactions"].unionByName(
        silver["partner_transactions"].withColumn("updated_at", F.col("updated_at")))
    m = p.build(silver)
    with pytest.raises(PipelineFailed, match="unique"):
        p.test(m)


def test_failing_staging_test_leaves_the_published_gold(spark, tmp_dir):
    run_pipeline(spark, SF_SMALL, tmp_dir, NOW)
    before = sorted(map(tuple, read_gold(spark, tmp_dir, "mart_transactions").select("transaction_id", "state").collect()), key=str)
    p = DailyPipeline(spark, SF_SMALL, tmp_dir, NOW)
    promote_all = p.promote_all

    def doubled():
        silver = promote_all()
        silver["bank_transactions"] = silver["bank_transactions"].unionByName(silver["bank_transactions"])
        return silver

    p.promote_all = doubled
    built = []
    p.build = lambda silver: built.append(1)
    with pytest.raises(PipelineFailed, match="unique"):
        p.run()
    after = sorted(map(tuple, read_gold(spark, tmp_dir, "mart_transactions").select("transaction_id", "state").collect()), key=str)
    assert before == after and before and not built
