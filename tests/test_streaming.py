"""Bounded drains: idempotence, replay after state loss, time bounds, routing, late updates."""

import pytest
from pyspark.sql import functions as F

from settlekit.fixtures import Feed
from settlekit.streaming import drain as DR
from settlekit.streaming import messages as MSG
from settlekit.streaming import upsert as UP

from paths import SF_SMALL


def _events(spark):
    return Feed(spark, SF_SMALL).table("events")


def test_second_drain_reads_nothing_and_third_only_new(spark, tmp_dir):
    msgs = MSG.event_messages(_events(spark))
    early = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp_ntz")
    log, out, ckpt = f"{tmp_dir}/log", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt"
    MSG.write_segment(msgs.filter(early), log)
    n1 = DR.drain(DR.read_log(spark, log), DR.append_sink(out, MSG.decoded_events, {"drain_run": 1}), ckpt)
    n2 = DR.drain(DR.read_log(spark, log), DR.append_sink(out, MSG.decoded_events, {"drain_run": 2}), ckpt)
    MSG.write_segment(msgs.filter(~early), log)
    n3 = DR.drain(DR.read_log(spark, log), DR.append_sink(out, MSG.decoded_events, {"drain_run": 3}), ckpt)
    total = _events(spark).count()
    assert n1 > 0 and n2 == 0 and n1 + n3 == total
    assert DR.read_sink(spark, out).count() == total


def test_lost_state_replays_from_earliest_and_dedup_absorbs_it(spark, tmp_dir):
    log, out = f"{tmp_dir}/log", f"{tmp_dir}/bronze"
    MSG.write_segment(MSG.event_messages(_events(spark)), log)
    keep = ("topic", "partition", "offset")
    for run, ck in ((1, "a"), (2, "b")):
        DR.drain(DR.read_log(spark, log), DR.append_sink(out, lambda b: MSG.decoded_events(b, keep), {"drain_run": run}),
                 f"{tmp_dir}/{ck}")
    landed = DR.read_sink(spark, out)
    n = _events(spark).count()
    assert landed.count() == 2 * n and landed.dropDuplicates(list(keep)).count() == n


def test_time_range_arguments_are_validated():
    with pytest.raises(ValueError, match="start_from"):
        DR.check_time_range(None, "2024-01-02")
    with pytest.raises(ValueError, match="before"):
        DR.check_time_range("2024-01-03", "2024-01-02")
    DR.check_time_range("2024-01-01", None)


def test_envelope_hashes_null_key_as_text_none(spark):
    msgs = spark.createDataFrame([("t", 0, 5, None, 0, None, "{}")],
                                 "topic string, partition int, offset long, timestamp timestamp_ntz, "
                                 "timestampType int, key string, value string")
    got = DR.envelope(msgs).first()
    import hashlib
    assert got["_kafka_msg_id"] == hashlib.md5(b"t0None").hexdigest()
    assert got["_kafka"]["data"] == "{}" and got["_kafka"]["ts"]["type"] == 0


def test_late_older_versions_do_not_override_newer(spark, tmp_dir):
    v = Feed(spark, SF_SMALL).versions()
    v.filter(F.col("state") != "initiated").write.parquet(f"{tmp_dir}/in/run=1")
    table = f"{tmp_dir}/silver"
    for run in (1, 2):
        if run == 2:
            v.filter(F.col("state") == "initiated").write.parquet(f"{tmp_dir}/in/run=2")
        # every run with a checkpoint of its own: batch ids start at 0 again
        DR.drain(spark.readStream.schema(v.schema).parquet(f"{tmp_dir}/in/run={run}"), UP.versions_sink(table),
                 f"{tmp_dir}/ckpt-{run}")
    final = UP.read_current(spark, table)
    assert spark.read.parquet(f"{table}/versions").count() == v.count()
    assert final.count() == v.select("transaction_id").distinct().count()
    assert final.filter(F.col("state") == "initiated").count() == 0


def test_a_table_that_cannot_be_read_raises(spark, tmp_dir):
    with pytest.raises(Exception, match="(?i)path"):
        UP.read_current(spark, f"{tmp_dir}/none")


def _message(i, ts="2024-01-01 00:00:00"):
    return ("t", 0, i, ts, 0, None, "{}")


def _messages(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp string, timestampType int, key string, value string").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz"))


def test_counts_hold_beyond_the_retained_progress(spark, tmp_dir):
    _messages(spark, [_message(i) for i in range(115)]).coalesce(1).write.option("maxRecordsPerFile", 1).parquet(f"{tmp_dir}/log")
    import glob
    files = len(glob.glob(f"{tmp_dir}/log/*.parquet"))
    assert files == 115
    seen = []
    n = DR.drain(DR.read_log(spark, f"{tmp_dir}/log", files_per_batch=1), lambda b, key: seen.append(key), f"{tmp_dir}/ck")
    assert n == 115 and len(set(seen)) == files          # a sink without an action, more batches than progress updates
    two = lambda b, key: (b.count(), b.count())
    assert DR.drain(DR.read_log(spark, f"{tmp_dir}/log"), two, f"{tmp_dir}/ck2") == 115


def test_a_new_checkpoint_does_not_overwrite_landed_batches(spark, tmp_dir):
    log, out = f"{tmp_dir}/log", f"{tmp_dir}/out"
    _messages(spark, [_message(1)]).write.parquet(log)
    for ck in ("a", "b"):
        DR.drain(DR.read_log(spark, log), DR.append_sink(out), f"{tmp_dir}/{ck}")
        DR.drain(DR.read_log(spark, log), DR.routing_sink(f"{tmp_dir}/routed"), f"{tmp_dir}/{ck}-routed")
    assert DR.read_sink(spark, out).count() == 2 and DR.read_routed(spark, f"{tmp_dir}/routed").count() == 2


def test_queue_rows_become_utc_wall_time(spark):
    row = spark.sql("SELECT 't' AS topic, 0 AS partition, 1L AS offset, timestamp_micros(1704067200000000) AS timestamp, 0 AS timestampType, "
                    "CAST('k' AS BINARY) AS key, CAST('{}' AS BINARY) AS value")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = DR.from_queue(row).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert str(got["timestamp"]) == "2024-01-01 00:00:00" and (got["key"], got["value"]) == ("k", "{}")


def test_every_topic_lands_in_its_own_table_with_overrides(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    MSG.write_segment(MSG.event_messages(_events(spark)), log)
    root = f"{tmp_dir}/tables"
    DR.drain(DR.read_log(spark, log), DR.routing_sink(root, {"events.error": "error_log"}), f"{tmp_dir}/ckpt")
    tables = {r["table_name"]: r["n"] for r in
              DR.read_routed(spark, root).groupBy("table_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(tables) == {"error_log", "events_click", "events_view", "events_purchase", "events_signup"}
    assert sum(tables.values()) == _events(spark).count()
    assert DR.read_routed(spark, root, "error_log").filter(F.col("topic") != "events.error").count() == 0


def test_malformed_message_body_fails_the_drain(spark, tmp_dir):
    bad = spark.createDataFrame([("events.click", 0, 1, None, 0, "7", "{not json")],
                                "topic string, partition int, offset long, timestamp timestamp_ntz, "
                                "timestampType int, key string, value string")
    MSG.write_segment(bad, f"{tmp_dir}/log")
    with pytest.raises(Exception, match="(?i)malformed|parse|json"):
        DR.drain(DR.read_log(spark, f"{tmp_dir}/log"), DR.append_sink(f"{tmp_dir}/out", MSG.decoded_events),
                 f"{tmp_dir}/ck")
