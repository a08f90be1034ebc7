"""Keyed tables, folding of late updates and incremental promotion."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from settlekit.contracts import PARTNER_COLUMNS
from settlekit.fixtures import Feed
from settlekit.operators import joins
from settlekit.operators.promote import latest_per_key, promote
from settlekit.sources import bronze as B
from settlekit.sources.commits import CommitConflict
from settlekit.sources.keyed import KeyedTable
from settlekit.sources.silver import promote_incremental, silver_table
from settlekit.streaming import upsert as UP

from paths import SF_SMALL

SCHEMA = "transaction_id string, updated_at timestamp_ntz, state string, amount_cents long"
DAY = dt.datetime(2024, 1, 1)


def _df(spark, rows):
    return spark.createDataFrame([(k, None if d is None else DAY + dt.timedelta(days=d), s, a) for k, d, s, a in rows], SCHEMA)


def _set(df):
    return sorted(map(tuple, df.select("transaction_id", "updated_at", "state", "amount_cents").collect()), key=repr)


def _snapshot(table):
    return {b: sorted((p, f, os.path.getmtime(f"{p}/{f}")) for p in paths for f in os.listdir(p)) for b, paths in table.files().items()}


@pytest.mark.parametrize("broadcast", [True, False])
def test_merges_equal_a_full_rebuild_and_leave_other_buckets(spark, tmp_dir, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 0)
        monkeypatch.setattr("settlekit.sources.keyed.bounded_broadcast", lambda df, **k: df)
    rng, table, rows = random.Random(3), KeyedTable(spark, f"{tmp_dir}/t", buckets=16), []
    for size in (300, 3, 1, 40):
        new = [(f"t{rng.randrange(200)}", rng.choice([None, *range(9)]), rng.choice(["a", "b", None]), rng.choice([None, 1, 2])) for _ in range(size)]
        new += [(None, 1, "a", size), new[0]]  # a null key, and a repeated row
        rows += new
        before = _snapshot(table) if table.exists() else {}
        done = table.merge(_df(spark, new).withColumn("extra", F.lit(1)).select("extra", *[c.split()[0] for c in SCHEMA.split(", ")]))
        assert done.buckets == 16 and done.touched <= min(16, len({r[0] for r in new}))
        after = _snapshot(table)
        changed = [b for b in after if after[b] != before.get(b)]
        assert len(changed) == done.touched and (size > 40 or done.touched < 16)
        assert _set(table.read()) == _set(latest_per_key(_df(spark, rows)))
    assert table.read().filter("transaction_id IS NULL").count() == 1


def test_a_merge_that_dies_leaves_the_table_and_a_second_writer_starts_anew(spark, tmp_dir):
    table = KeyedTable(spark, f"{tmp_dir}/t", buckets=4)
    with pytest.raises(FileNotFoundError):
        table.read()
    table.merge(_df(spark, [(f"t{i}", 1, "a", i) for i in range(50)]))
    whole = _set(table.read())
    dies = _df(spark, [(f"t{i}", 2, "b", i) for i in range(50)]).withColumn(
        "state", F.when(F.col("amount_cents") == 33, F.raise_error(F.lit("executor gone"))).otherwise(F.col("state")))
    with pytest.raises(Exception, match="executor gone"):
        table.merge(dies)
    assert _set(table.read()) == whole
    other = KeyedTable(spark, f"{tmp_dir}/t")

    def meanwhile(marks):
        other.merge(_df(spark, [("t1", 3, "c", 1)]))

    with pytest.raises(CommitConflict):
        table.merge(_df(spark, [("t2", 3, "c", 2)]), meanwhile)
    assert dict((r[0], r[2]) for r in _set(table.read()))["t1"] == "c" and len(whole) == table.read().count()
    table.merge(_df(spark, []))
    assert table.read().count() == 50 and "Exchange" not in table.read()._jdf.queryExecution().toString()


def test_touched_buckets_are_not_shuffled_for_a_small_increment(spark, tmp_dir):
    table = KeyedTable(spark, f"{tmp_dir}/t", buckets=8)
    table.merge(_df(spark, [(f"t{i}", 1, "a", i) for i in range(500)]))
    number, document = table.commits.latest()
    newest = _df(spark, [("t1", 2, "b", 1)]).withColumn("bucket", table.bucket_of(8))
    plan = table._merged(document, newest, [c.split()[0] for c in SCHEMA.split(", ")], {int(newest.first()["bucket"])})._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_folded_batches_go_and_late_ones_still_lose(spark, tmp_dir):
    root = f"{tmp_dir}/s"
    write = lambda name, rows: _df(spark, rows).write.parquet(f"{root}/versions/batch={name}")
    write("a-0", [("t1", 5, "settled", 1), ("t2", 1, "initiated", 2)])
    assert UP.read_current(spark, root).count() == 2
    assert UP.fold(spark, root, buckets=4).keys == 2
    write("a-1", [("t1", 2, "late", 1), ("t2", 3, "settled", 2), ("t3", 1, "initiated", 3)])
    state = lambda: {r["transaction_id"]: r["state"] for r in UP.read_current(spark, root).collect()}
    assert state() == {"t1": "settled", "t2": "settled", "t3": "initiated"}
    assert os.path.exists(f"{root}/versions/batch=a-0")  # for readers that began before the fold
    UP.fold(spark, root)
    assert not os.path.exists(f"{root}/versions/batch=a-0") and state() == {"t1": "settled", "t2": "settled", "t3": "initiated"}
    assert UP.fold(spark, root) is None
    write("b-0", [("t3", 9, "settled", 3)])
    UP.fold(spark, root)
    assert state()["t3"] == "settled" and os.listdir(f"{root}/versions") == ["batch=b-0"]


def test_incremental_promotion_reads_only_new_loads(spark, tmp_dir):
    bronze = Feed(spark, SF_SMALL).partner_bronze()
    parts = [bronze.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == i).select(*PARTNER_COLUMNS) for i in range(3)]
    B.write_bronze(parts[0], tmp_dir, "kafka_drain", "partner_transactions", "append")
    B.write_bronze(parts[1], tmp_dir, "partner_db", "partner_transactions")
    first = promote_incremental(spark, tmp_dir, "partner_transactions", buckets=8)
    assert sorted(first.loads) == ["kafka_drain", "partner_db"] and first.rows == parts[0].count() + parts[1].count()
    B.write_bronze(parts[2], tmp_dir, "kafka_drain", "partner_transactions", "append")
    second = promote_incremental(spark, tmp_dir, "partner_transactions")
    assert list(second.loads) == ["kafka_drain"] and len(second.loads["kafka_drain"]) == 1 and second.rows == parts[2].count()
    third = promote_incremental(spark, tmp_dir, "partner_transactions")
    assert third.loads == {} and third.merged is None
    full = promote(B.read_bronze(spark, tmp_dir, "partner_transactions"), "partner_transactions")
    got = silver_table(spark, tmp_dir, "partner_transactions").read()
    assert got.exceptAll(full).isEmpty() and full.exceptAll(got).isEmpty() and got.columns == full.columns


def test_a_new_snapshot_is_read_from_the_lookback_on(spark, tmp_dir):
    rows = Feed(spark, SF_SMALL).partner().select(*PARTNER_COLUMNS)
    newest = rows.agg(F.max("updated_at")).first()[0]
    B.write_bronze(rows, tmp_dir, "partner_db", "partner_transactions")
    promote_incremental(spark, tmp_dir, "partner_transactions", dt.timedelta(days=30), buckets=8)
    later = F.lit((newest + dt.timedelta(hours=1)).isoformat(sep=" ")).cast("timestamp_ntz")
    hit = F.pmod(F.xxhash64("transaction_id"), F.lit(50)) == 0
    changed = rows.withColumn("state", F.when(hit, "refunded").otherwise(F.col("state"))).withColumn("updated_at", F.when(hit, later).otherwise(F.col("updated_at")))
    B.write_bronze(changed, tmp_dir, "partner_db", "partner_transactions")
    done = promote_incremental(spark, tmp_dir, "partner_transactions", dt.timedelta(days=30))
    inside = changed.filter(F.col("updated_at") >= F.lit((newest - dt.timedelta(days=30)).isoformat(sep=" ")).cast("timestamp_ntz")).count()
    assert done.rows == inside < changed.count() and silver_table(spark, tmp_dir, "partner_transactions").marks()["newest"]["partner_db"] == (newest + dt.timedelta(hours=1)).isoformat()
    got = silver_table(spark, tmp_dir, "partner_transactions").read()
    assert got.exceptAll(changed).isEmpty() and changed.exceptAll(got).isEmpty()
