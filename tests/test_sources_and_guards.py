"""Sources, canonicalisation and the three negative tests (identifier guard,
schema drift, duplicates caught)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from settlekit.contracts import PARTNER_COLUMNS, PARTNER_SCHEMA
from settlekit.fixtures import Feed
from settlekit.operators import quality as Q
from settlekit.operators.canonical import (IdentifierGuardError, SchemaDriftError, canonicalize, check_messages,
                                           enforce_contract, guard_identifiers, schema_drift)
from settlekit.operators.promote import promote
from settlekit.sources import bronze as B
from settlekit.sources import csv_drop as CSV
from settlekit.sources.jdbc import snapshot_jdbc, write_jdbc

from paths import SF_SMALL

HEADER = ",".join(PARTNER_COLUMNS)
ROW = ("txn-1,partner_acme,bank_chase,1234,USD,settled,,2024-01-01T00:00:00,2024-01-01T00:00:01,"
       "2024-01-01T00:00:40,2024-01-01T00:03:00,,,2024-01-01T00:03:00")


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_csv_drops_are_read_by_header_name_not_position(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "partner_transactions_20240101_000000.csv"), [HEADER, ROW])
    rev_header = ",".join(reversed(PARTNER_COLUMNS))
    rev_row = ",".join(reversed(ROW.replace("txn-1", "txn-2").split(",")))
    _write(os.path.join(tmp_dir, "partner_transactions_20240102_000000.csv"), [rev_header, rev_row])
    _write(os.path.join(tmp_dir, "bank_transactions_20240102_000000.csv"), ["x", "y"])  # other table: ignored
    rows = canonicalize(CSV.read_csv_drops(spark, tmp_dir, "partner_transactions"), "partner_transactions")
    got = {r["transaction_id"]: r for r in rows.collect()}
    assert set(got) == {"txn-1", "txn-2"}
    for r in got.values():
        assert r["partner_id"] == "partner_acme" and r["amount_cents"] == 1234
        assert r["decline_reason"] is None and r["failed_at"] is None            # '' -> NULL
        assert r["captured_at"] == dt.datetime(2024, 1, 1, 0, 0, 40)
    assert rows.schema == PARTNER_SCHEMA


def test_identifier_guard_refuses_the_whole_batch_and_writes_nothing(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "partner_transactions_20240101_000000.csv"),
           [HEADER, ROW, ROW.replace("txn-1", "4111111111111111")])
    rows = canonicalize(CSV.read_csv_drops(spark, tmp_dir, "partner_transactions"), "partner_transactions")
    root = os.path.join(tmp_dir, "lake")
    with pytest.raises(IdentifierGuardError, match="transaction_id"):
        B.write_bronze(rows, root, "sftp_drop", "partner_transactions")
    assert not os.path.exists(B.bronze_path(root, "sftp_drop", "partner_transactions"))


def test_schema_drift_new_column_fails_before_reading(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "partner_transactions_20240101_000000.csv"),
           [HEADER + ",surprise_risk_score", ROW + ",0.93"])
    with pytest.raises(SchemaDriftError, match="surprise_risk_score"):
        CSV.read_csv_drops(spark, tmp_dir, "partner_transactions")


def test_schema_contract_freezes_columns_and_types_but_tolerates_missing(spark):
    clean = spark.createDataFrame([], PARTNER_SCHEMA)
    enforce_contract(clean.drop("initiated_at"), PARTNER_SCHEMA)   # missing column tolerated
    retyped = clean.withColumn("amount_cents", F.col("amount_cents").cast("string"))
    with pytest.raises(SchemaDriftError, match="type_changed:amount_cents"):
        enforce_contract(retyped, PARTNER_SCHEMA)
    kinds = {d.kind for d in schema_drift(PARTNER_SCHEMA, retyped.drop("state").withColumn("x", F.lit(1)).schema)}
    assert kinds == {"new_column", "type_changed", "missing_ok"}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_timestamp_text_raises_instead_of_becoming_null(spark, ansi):
    df = spark.createDataFrame([("t", "not-a-time")], "transaction_id string, updated_at string")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="updated_at"):
            canonicalize(df, "partner_transactions").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_dedup_off_is_caught_by_unique_and_dedup_on_passes(spark):
    bronze = Feed(spark, SF_SMALL).partner_bronze()
    assert Q.unique(promote(bronze, "partner_transactions", dedup=False), "transaction_id").count() > 0
    assert Q.unique(promote(bronze, "partner_transactions"), "transaction_id").count() == 0


def test_bronze_channels_union_by_name_in_one_scan(spark, tmp_dir):
    bronze = Feed(spark, SF_SMALL).partner_bronze()
    for ch in ("partner_db", "sftp_drop", "kafka_drain"):
        rows = bronze.filter(F.col("channel") == ch).select(*PARTNER_COLUMNS)
        if ch == "kafka_drain":
            rows = rows.withColumn("_kafka_msg_id", F.md5("transaction_id"))
        B.write_bronze(rows, tmp_dir, ch, "partner_transactions")
    back = B.read_bronze(spark, tmp_dir, "partner_transactions")
    assert back.count() == bronze.count()
    assert back.columns == ["channel", *PARTNER_COLUMNS]
    assert {r[0] for r in back.select("channel").distinct().collect()} == {"partner_db", "sftp_drop", "kafka_drain"}


def test_jdbc_snapshot_partitioned_read_in_process_derby(spark):
    """Derby runs embedded in the driver JVM (no server, no port)."""
    url = "jdbc:derby:memory:settlekit_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    src = Feed(spark, SF_SMALL).partner().select(
        F.regexp_extract("transaction_id", r"(\d+)$", 1).cast("bigint").alias("id"), "transaction_id",
        "partner_id", "amount_cents")
    write_jdbc(src, url, "PARTNER_TRANSACTIONS", properties=props)
    back = snapshot_jdbc(spark, url, "PARTNER_TRANSACTIONS", "ID", 0, 6000, 4, properties=props)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == src.count()
    assert back.agg(F.sum("AMOUNT_CENTS")).first()[0] == src.agg(F.sum("amount_cents")).first()[0]


def test_guard_counts_every_string_column_in_one_pass(spark):
    df = spark.createDataFrame([("a 4111111111111111", "x"), ("ok", "y")], "a string, b string")
    with pytest.raises(IdentifierGuardError, match="'a'"):
        guard_identifiers(df)
    assert guard_identifiers(df.select("b")) is not None


def test_remote_headers_are_read_in_one_spark_job(spark, tmp_dir, monkeypatch):
    from settlekit.sources import fs
    paths = []
    for i in range(3):
        _write(os.path.join(tmp_dir, f"f{i}.csv"), [f"h{i}a,h{i}b", "1,2", "3,4"])
        paths.append("file://" + os.path.join(tmp_dir, f"f{i}.csv"))
    monkeypatch.setattr(fs, "local_path", lambda p, spark: None)     # take the object-store path
    assert fs.first_lines(spark, paths) == {p: f"h{i}a,h{i}b" for i, p in enumerate(paths)}


def test_offsets_in_timestamps_are_honoured(spark):
    texts = ["2026-01-01T10:00:00+02:00", "2026-01-01T10:00:00Z", "2026-01-01T10:00:00", "2026-01-01 10:00:00.5-0330", "2026-01-01", ""]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "transaction_id string, updated_at string")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = {r["transaction_id"]: r["updated_at"] for r in canonicalize(df, "partner_transactions").collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        at = lambda *a: dt.datetime(2026, 1, 1, *a)
        assert [got[str(i)] for i in range(6)] == [at(8), at(10), at(10), at(13, 30, 0, 500_000), at(), None]


@pytest.mark.parametrize(("body", "error", "match"), [
    ('{"transaction_id": "t1", "state": "settled", "surprise_risk_score": 0.9}', SchemaDriftError, "surprise_risk_score"),
    ('{"transaction_id": "t1", "state": "settled", "note": "4111111111111111"}', SchemaDriftError, "note"),
    ('{"transaction_id": "t1", "state": "4111111111111111"}', IdentifierGuardError, "state")])
def test_every_field_of_a_message_is_checked(spark, body, error, match):
    good = '{"transaction_id": "t0", "state": null, "amount_cents": 5}'
    df = spark.createDataFrame([("a", good), ("a", body), ("unrouted", '{"x": 1}')], "topic string, value string")
    with pytest.raises(error, match=match):
        check_messages(df, {"a": PARTNER_SCHEMA})
    check_messages(df.filter(F.col("value") != body), {"a": PARTNER_SCHEMA})


def test_refused_queue_batch_leaves_the_earlier_bronze(spark, tmp_dir):
    from settlekit.plans.pipeline import DailyPipeline

    p = DailyPipeline(spark, SF_SMALL, tmp_dir, "2001-08-03 06:00:00")
    p.extract_queue()
    path = B.bronze_path(tmp_dir, "kafka_drain", "partner_transactions")
    before = spark.read.parquet(path).count()
    bad = spark.createDataFrame([("partner-transactions", 0, 1, None, 0, "k", '{"transaction_id": "t", "extra": "1"}')],
                                "topic string, partition int, offset long, timestamp timestamp_ntz, timestampType int, key string, value string")
    bad.write.parquet(f"{tmp_dir}/landing/queue/late")
    rows = p._channel_rows
    p._channel_rows = lambda table, channel: rows(table, channel).limit(0)
    with pytest.raises(Exception, match="extra"):
        p.extract_queue()
    assert spark.read.parquet(path).count() == before > 0


def test_jdbc_slices_by_predicates(spark):
    url = "jdbc:derby:memory:settlekit_slices;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    src = Feed(spark, SF_SMALL).partner().select("transaction_id", "partner_id")
    write_jdbc(src, url, "T", properties=props)
    slices = ['CAST("partner_id" AS VARCHAR(64)) ' + c for c in ("< 'partner_h'", ">= 'partner_h'")]
    back = snapshot_jdbc(spark, url, "T", predicates=slices, properties=props)
    assert back.rdd.getNumPartitions() == 2 and back.count() == src.count()
    with pytest.raises(ValueError, match="bound"):
        snapshot_jdbc(spark, url, "T", "ID")


def test_paths_without_a_scheme_belong_to_the_default_store(spark):
    from settlekit.sources import fs

    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    try:
        assert fs.local_path("/data/x", spark) == "/data/x"
        conf.set("fs.defaultFS", "hdfs://namenode")
        assert fs.local_path("/data/x", spark) is None and fs.local_path("file:///data/x", spark) == "/data/x"
    finally:
        conf.set("fs.defaultFS", before)
