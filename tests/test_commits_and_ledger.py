"""Commits, atomic loads, the schema registry, the offset ledger, recreated logs and error classes."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from settlekit.contracts import PARTNER_COLUMNS
from settlekit.fixtures import Feed
from settlekit.operators.canonical import SchemaDriftError
from settlekit.sources import bronze as B
from settlekit.sources.commits import CommitConflict, CommitLog
from settlekit.streaming import faults
from settlekit.streaming import ledger as LD

from paths import SF_SMALL


# ---- commits -------------------------------------------------------------------------

def test_one_of_two_writers_of_a_number_fails(spark, tmp_dir):
    for root in (f"{tmp_dir}/a", f"file://{tmp_dir}/b"):
        log = CommitLog(spark, root)
        assert log.latest() == (0, {})
        log.commit(0, {"x": "é"})
        with pytest.raises(CommitConflict):
            log.commit(0, {"x": 2})
        assert log.latest() == (1, {"x": "é"})
        assert log.change(lambda d: d.update(y=1)) == (2, {"x": "é", "y": 1})
        log.change(lambda d: d.update(y=2))
        assert [d["y"] for d in log.kept(2)] == [1, 2] and log.numbers() == [2, 3]


def test_change_starts_anew_from_another_writers_state(spark, tmp_dir):
    log, other = CommitLog(spark, f"{tmp_dir}/c"), CommitLog(spark, f"{tmp_dir}/c")
    turns = []

    def edit(document):
        if not turns:
            other.commit(0, {"theirs": 1})
        turns.append(1)
        document["mine"] = 1

    assert log.change(edit) == (2, {"theirs": 1, "mine": 1}) and len(turns) == 2


# ---- loads ---------------------------------------------------------------------------

def _rows(spark, n, amount=5):
    full = Feed(spark, SF_SMALL).partner().select(*PARTNER_COLUMNS).orderBy("transaction_id").limit(n)
    return full.withColumn("amount_cents", F.lit(amount).cast("long"))


def _amounts(spark, root):
    return {(r["channel"], r["amount_cents"]): r["count"] for r in B.read_bronze(spark, root, "partner_transactions").groupBy("channel", "amount_cents").count().collect()}


def test_a_write_that_dies_midway_leaves_the_previous_load(spark, tmp_dir):
    B.write_bronze(_rows(spark, 40, 1), tmp_dir, "partner_db", "partner_transactions")
    B.write_bronze(_rows(spark, 7, 9), tmp_dir, "sftp_drop", "partner_transactions")
    dies = _rows(spark, 40, 2).repartition(8, "transaction_id").withColumn(
        "currency", F.when(F.spark_partition_id() == 5, F.raise_error(F.lit("disk gone"))).otherwise(F.col("currency")))
    with pytest.raises(Exception, match="disk gone"):
        B.write_bronze(dies, tmp_dir, "partner_db", "partner_transactions", validate=False)
    assert _amounts(spark, tmp_dir) == {("partner_db", 1): 40, ("sftp_drop", 9): 7}
    B.write_bronze(_rows(spark, 30, 2), tmp_dir, "partner_db", "partner_transactions")
    assert _amounts(spark, tmp_dir) == {("partner_db", 2): 30, ("sftp_drop", 9): 7}


def test_unpublished_files_do_not_count_and_go_with_the_next_load(spark, tmp_dir, monkeypatch):
    path = B.bronze_path(tmp_dir, "partner_db", "partner_transactions")
    B.write_bronze(_rows(spark, 10, 1), tmp_dir, "partner_db", "partner_transactions")
    with monkeypatch.context() as m:  # the driver dies after the write, before the commit
        m.setattr(CommitLog, "change", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver gone")))
        with pytest.raises(RuntimeError, match="driver gone"):
            B.write_bronze(_rows(spark, 10, 2), tmp_dir, "partner_db", "partner_transactions")
    assert len(os.listdir(path)) == 2 and _amounts(spark, tmp_dir) == {("partner_db", 1): 10}
    B.write_bronze(_rows(spark, 10, 3), tmp_dir, "partner_db", "partner_transactions")
    B.write_bronze(_rows(spark, 10, 4), tmp_dir, "partner_db", "partner_transactions")
    assert len(os.listdir(path)) == 2 and _amounts(spark, tmp_dir) == {("partner_db", 4): 10}  # this load and the one before


def test_a_reader_of_the_replaced_load_can_end(spark, tmp_dir):
    B.write_bronze(_rows(spark, 10, 1), tmp_dir, "partner_db", "partner_transactions")
    before = B.read_bronze(spark, tmp_dir, "partner_transactions")
    B.write_bronze(_rows(spark, 5, 2), tmp_dir, "partner_db", "partner_transactions")
    assert before.count() == 10 and B.read_bronze(spark, tmp_dir, "partner_transactions").count() == 5


def test_append_adds_and_an_unknown_disposition_is_refused(spark, tmp_dir):
    for amount in (1, 2):
        B.write_bronze(_rows(spark, 4, amount), tmp_dir, "kafka_drain", "partner_transactions", "append")
    assert _amounts(spark, tmp_dir) == {("kafka_drain", 1): 4, ("kafka_drain", 2): 4}
    with pytest.raises(ValueError, match="upsert"):
        B.write_bronze(_rows(spark, 1), tmp_dir, "kafka_drain", "partner_transactions", "upsert")
    with pytest.raises(FileNotFoundError):
        B.read_bronze(spark, tmp_dir, "bank_transactions")


# ---- the schema registry --------------------------------------------------------------

def test_drift_fails_the_load_and_its_removal_recovers(spark, tmp_dir):
    """A drifted drop fails the extraction and nothing of it is seen; without it the next run passes."""
    load = lambda df: B.write_bronze(df, tmp_dir, "sftp_drop", "partner_transactions")
    load(_rows(spark, 10, 1))
    folders = os.listdir(B.bronze_path(tmp_dir, "sftp_drop", "partner_transactions"))
    with pytest.raises(SchemaDriftError, match="new_column:surprise_risk_score"):
        load(_rows(spark, 10, 2).withColumn("surprise_risk_score", F.lit(0.97)))
    renamed = _rows(spark, 10, 2).withColumnRenamed("currency", "currency_code")  # a new column and a missing one
    with pytest.raises(SchemaDriftError, match="new_column:currency_code"):
        load(renamed)
    with pytest.raises(SchemaDriftError, match="type_changed:amount_cents"):
        load(_rows(spark, 10, 2).withColumn("amount_cents", F.col("amount_cents").cast("int")))
    assert os.listdir(B.bronze_path(tmp_dir, "sftp_drop", "partner_transactions")) == folders
    assert _amounts(spark, tmp_dir) == {("sftp_drop", 1): 10}
    load(_rows(spark, 10, 2))
    assert _amounts(spark, tmp_dir) == {("sftp_drop", 2): 10}


def test_first_load_freezes_per_channel_and_table_and_approval_opens(spark, tmp_dir):
    narrow = _rows(spark, 5).drop("refunded_at").withColumn("_source_file", F.lit("a.csv"))
    B.write_bronze(narrow, tmp_dir, "partner_db", "partner_transactions")
    frozen = B.frozen_schema(spark, tmp_dir, "partner_db", "partner_transactions")
    assert frozen.names == [c for c in PARTNER_COLUMNS if c != "refunded_at"]  # transport metadata is not frozen
    with pytest.raises(SchemaDriftError, match="refunded_at"):
        B.write_bronze(_rows(spark, 5), tmp_dir, "partner_db", "partner_transactions")
    B.write_bronze(_rows(spark, 5), tmp_dir, "sftp_drop", "partner_transactions")  # another channel
    B.write_bronze(narrow.drop("_source_file", "failed_at"), tmp_dir, "partner_db", "partner_transactions")  # missing ones pass, and stay frozen
    assert B.frozen_schema(spark, tmp_dir, "partner_db", "partner_transactions") == frozen
    odd = spark.createDataFrame([(1, "x")], "id int, note string")
    B.write_bronze(odd, tmp_dir, "partner_db", "notes")  # a new table
    with pytest.raises(SchemaDriftError, match="extra"):
        B.write_bronze(odd.withColumn("extra", F.lit(1)), tmp_dir, "partner_db", "notes")
    assert B.approve_schema(spark, tmp_dir, "partner_db", "partner_transactions", _rows(spark, 1).schema) == 2
    B.write_bronze(_rows(spark, 6), tmp_dir, "partner_db", "partner_transactions")
    assert [len(s) for s in B.schema_versions(spark, tmp_dir, "partner_db", "partner_transactions")] == [13, 14]
    assert B.frozen_schema(spark, tmp_dir, "bank_db", "bank_transactions") is None


def test_a_refused_first_load_freezes_nothing(spark, tmp_dir):
    bad = _rows(spark, 5).withColumn("currency", F.lit("4111111111111111"))
    with pytest.raises(ValueError, match="currency"):
        B.write_bronze(bad, tmp_dir, "partner_db", "partner_transactions")
    assert B.frozen_schema(spark, tmp_dir, "partner_db", "partner_transactions") is None


# ---- the ledger ------------------------------------------------------------------------

def _messages(spark, rows):
    """(topic, partition, offset, day of January 2024) rows."""
    full = [(t, p, o, dt.datetime(2024, 1, 1) + dt.timedelta(days=d), 0, None, f'{{"n": {o}}}') for t, p, o, d in rows]
    return spark.createDataFrame(full, "topic string, partition int, offset long, timestamp timestamp_ntz, timestampType int, key string, value string")


def _append(spark, folder, rows):
    _messages(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def _drain(spark, root):
    return LD.LedgerDrain(LD.MessageLog(spark, f"{root}/the log", f"{root}/segments"), CommitLog(spark, f"{root}/ledger"))


def _landed(spark, root, drain):
    return sorted((r["topic"], r["partition"], r["offset"]) for r in LD.read_landed(spark, f"{root}/out", drain.commits).collect())


def test_ledger_reads_only_new_messages_and_a_lone_one(spark, tmp_dir):
    drain, sink = _drain(spark, tmp_dir), LD.landing_sink(f"{tmp_dir}/out")
    _append(spark, f"{tmp_dir}/the log", [("a", 0, i, 0) for i in range(5)] + [("a", 1, 7, 0), ("b", 0, 100, 0)])
    first = drain.run(sink)
    assert first.landed == {("a", 0): 5, ("a", 1): 1, ("b", 0): 1} and drain.offsets() == {("a", 0): 5, ("a", 1): 8, ("b", 0): 101}
    assert drain.run(sink).batches == []  # nothing new, nothing written
    _append(spark, f"{tmp_dir}/the log", [("b", 0, 101, 1)])
    one = drain.run(sink)
    assert one.landed == {("b", 0): 1} and (one.files, one.files_read) == (2, 1)
    assert len(_landed(spark, tmp_dir, drain)) == 8 == len(set(_landed(spark, tmp_dir, drain)))


def test_time_bounds_become_offsets_and_later_messages_stay_unread(spark, tmp_dir):
    drain, sink = _drain(spark, tmp_dir), LD.landing_sink(f"{tmp_dir}/out")
    log = f"{tmp_dir}/the log"
    _append(spark, log, [("a", 0, i, i // 10) for i in range(25)])      # days 0 to 2
    _append(spark, log, [("a", 0, i, i // 10) for i in range(25, 50)])  # days 2 to 4
    _append(spark, log, [("a", 1, i, 9) for i in range(5)])
    bounded = drain.run(sink, start_from="2024-01-01", end_time="2024-01-02")
    assert bounded.ranges == [LD.Range("a", 0, 0, 10)] and (bounded.files, bounded.files_read) == (3, 1)
    assert drain.run(sink, start_from="2024-01-02", end_time="2024-01-04").landed == {("a", 0): 20}
    assert drain.run(sink).landed == {("a", 0): 20, ("a", 1): 5}
    assert drain.run(sink).rows == 0 and len(set(_landed(spark, tmp_dir, drain))) == 55 == len(_landed(spark, tmp_dir, drain))
    with pytest.raises(ValueError, match="start_from"):
        drain.run(sink, end_time="2024-01-02")


def test_time_lookup_against_brute_force_with_times_out_of_order(spark, tmp_dir):
    rows = [("a", i % 3, i, (i * 7) % 11 + i // 20) for i in range(90)]
    for k in range(0, 90, 30):
        _append(spark, f"{tmp_dir}/the log", rows[k:k + 30])
    log = _drain(spark, tmp_dir).log
    for day in range(0, 17, 2):
        plain = {}
        for t, p, o, d in rows:
            if d >= day:
                plain[(t, p)] = min(o, plain.get((t, p), o))
        assert log.offsets_at(log.segments(), dt.datetime(2024, 1, 1) + dt.timedelta(days=day)) == plain


def test_a_failed_sink_does_not_advance_the_ledger(spark, tmp_dir):
    drain, sink = _drain(spark, tmp_dir), LD.landing_sink(f"{tmp_dir}/out")
    _append(spark, f"{tmp_dir}/the log", [("a", 0, i, 0) for i in range(10)])

    def dies(batch, key):
        sink(batch, key)
        raise RuntimeError("sink gone")

    with pytest.raises(RuntimeError, match="sink gone"):
        drain.run(dies)
    assert drain.offsets() == {} and len(os.listdir(f"{tmp_dir}/out")) == 1
    assert drain.run(sink, batch_size=4).landed == {("a", 0): 10}
    assert [o for _, _, o in _landed(spark, tmp_dir, drain)] == list(range(10))  # what the failed drain left does not count
    assert LD.drop_uncommitted(spark, f"{tmp_dir}/out", drain.commits) == 1 and len(os.listdir(f"{tmp_dir}/out")) == 3


def test_a_wiped_and_refilled_log_is_read_from_its_start(spark, tmp_dir):
    drain, sink, log = _drain(spark, tmp_dir), LD.landing_sink(f"{tmp_dir}/out"), f"{tmp_dir}/the log"
    _append(spark, log, [("a", 0, i, 0) for i in range(10)] + [("a", 1, i, 0) for i in range(3)])
    drain.run(sink)
    shutil.rmtree(log)
    _append(spark, log, [("a", 0, i, 3) for i in range(4)] + [("a", 1, i, 0) for i in range(5)])  # fewer; and more of the same
    again = drain.run(sink)
    assert again.recreated == [("a", 0)] and again.landed == {("a", 0): 4, ("a", 1): 2}
    shutil.rmtree(log)
    _append(spark, log, [("a", 0, i, 5) for i in range(40)] + [("a", 1, i, 0) for i in range(5)])  # other messages, and more of them
    again = drain.run(sink)
    assert again.recreated == [("a", 0)] and again.landed == {("a", 0): 40}
    assert drain.run(sink).rows == 0


def test_lost_offsets_fail_unless_skipped(spark, tmp_dir):
    drain, sink, log = _drain(spark, tmp_dir), LD.landing_sink(f"{tmp_dir}/out"), f"{tmp_dir}/the log"
    _append(spark, log, [("a", 0, i, 0) for i in range(5)])
    drain.run(sink)
    shutil.rmtree(log)
    _append(spark, log, [("a", 0, i, 1) for i in range(8, 12)])  # 5 to 7 went with retention
    with pytest.raises(LD.OffsetsLost, match="5 to 7"):
        drain.run(sink)
    outcome = drain.run_with_retries(sink, skip_lost=True)
    assert outcome.status == "partial" and outcome.result.skipped == {("a", 0): (5, 8)} and outcome.result.landed == {("a", 0): 4}
    assert drain.run_with_retries(sink, skip_lost=True).status == "ok"


def test_no_log_and_ranges_for_a_queue(spark, tmp_dir):
    drain = _drain(spark, tmp_dir)
    assert drain.run(LD.landing_sink(f"{tmp_dir}/out")).rows == 0
    with pytest.raises(FileNotFoundError):
        LD.read_landed(spark, f"{tmp_dir}/out", drain.commits)
    options = LD.queue_range_options([LD.Range("a", 0, 1, 5), LD.Range("a", 1, 0, 2), LD.Range("b", 0, 7, 9)])
    assert options["startingOffsets"] == '{"a": {"0": 1, "1": 0}, "b": {"0": 7}}' and options["endingOffsets"] == '{"a": {"0": 5, "1": 2}, "b": {"0": 9}}'


# ---- error classes -----------------------------------------------------------------------

def test_a_source_that_fails_once_is_tried_again(spark, tmp_dir):
    drain, sink = _drain(spark, tmp_dir), LD.landing_sink(f"{tmp_dir}/out")
    _append(spark, f"{tmp_dir}/the log", [("a", 0, i, 0) for i in range(6)])
    calls, waits = [], []

    def flaky(batch, key):
        calls.append(key)
        if len(calls) == 2:
            raise ConnectionResetError("broker went away")
        sink(batch, key)

    outcome = drain.run_with_retries(flaky, batch_size=3, sleep=waits.append)
    assert (outcome.status, outcome.attempts, waits) == ("ok", 2, [1.0])
    assert outcome.errors == [("retriable", "ConnectionResetError: broker went away")]
    assert outcome.result.landed == {("a", 0): 3}  # the batch before the failure had been committed
    assert [o for _, _, o in _landed(spark, tmp_dir, drain)] == list(range(6))


def test_a_source_that_fails_for_good_gives_up_or_is_not_tried_again(spark, tmp_dir):
    waits = []
    with pytest.raises(TimeoutError):
        faults.with_retries(lambda: (_ for _ in ()).throw(TimeoutError("no answer")), attempts=3, sleep=waits.append)
    assert waits == [1.0, 2.0]
    drain = _drain(spark, tmp_dir)
    bad = _messages(spark, [("a", 0, 0, 0)]).withColumn("value", F.lit("{not json"))
    bad.write.parquet(f"{tmp_dir}/the log")
    from settlekit.streaming.messages import decoded_events
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        drain.run_with_retries(LD.landing_sink(f"{tmp_dir}/out", decoded_events), sleep=waits.append)
    assert waits == [1.0, 2.0] and drain.offsets() == {}


def test_classes_follow_the_chain_of_causes(spark):
    def chained(inner, outer):
        try:
            try:
                raise inner
            except Exception as e:
                raise outer from e
        except Exception as e:
            return e

    assert faults.classify(chained(ConnectionError("x"), RuntimeError("step failed: SocketTimeoutException"))) == "retriable"
    assert faults.classify(chained(SchemaDriftError("new column"), RuntimeError("SocketTimeoutException in the log line"))) == "fatal"
    assert faults.classify(faults.SoftFault("left out")) == "soft"
    assert faults.classify(CommitConflict("taken")) == "retriable"
    assert faults.classify(KeyError("x")) == "fatal"
    with pytest.raises(Exception) as java:
        spark.read.parquet("/nowhere/at/all")
    assert faults.classify(java.value) == "fatal"
    socket = spark._jvm.java.net.SocketTimeoutException("read timed out")
    with pytest.raises(Exception) as java:
        spark._jvm.org.apache.spark.SparkException("Job aborted", socket).getClass().getMethod("nope", None)
    wrapped = RuntimeError("x")
    wrapped.java_exception = spark._jvm.org.apache.spark.SparkException("Job aborted", socket)
    assert faults.classify(wrapped) == "retriable"
