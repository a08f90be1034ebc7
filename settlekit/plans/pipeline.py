"""The daily job: extract (4 channels) -> promote (2 tables) -> build -> tests -> freshness.

Each step is a set of DataFrame writes under ``out_root``. Extraction validates a
batch (identifier guard, frozen contract; for queue messages over every field of
the body) before writing it. Tests run in dependency order: the staging tests
before anything is built, the rest over gold, which is built in a folder of the
run's own and published only after they pass; a failure leaves the published gold
as it was. Freshness runs last so a stale source never blocks data.

The upstream systems are simulated from the fixture feed (``orders``): the
partner and bank databases as DataFrames (a JDBC snapshot in production, see
``sources.jdbc``), the SFTP drops as CSV files, the queue as a message log.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settlekit.contracts import TABLE_COLUMNS, TABLE_SCHEMAS, TOPIC_TABLES, text_schema
from settlekit.functions.columns import iso_text
from settlekit.fixtures import Feed, queue_messages
from settlekit.operators import quality as Q
from settlekit.operators.canonical import canonicalize, check_messages
from settlekit.operators.promote import promote
from settlekit.plans import suite as S
from settlekit.plans.model import Model
from settlekit.sources import bronze as B
from settlekit.sources import csv_drop as CSV
from settlekit.streaming import ledger as LD

TABLES = ("partner_transactions", "bank_transactions")
SIDE_BRONZE = {"partner_transactions": "partner_bronze", "bank_transactions": "bank_bronze"}
DB_CHANNEL = {"partner_transactions": "partner_db", "bank_transactions": "bank_db"}


class PipelineFailed(RuntimeError):
    pass


@dataclass
class StepResult:
    step: str
    table_name: str
    rows: int
    status: str


def _text(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            c = iso_text(c)
        out.append(c.cast("string").alias(f.name))
    return df.select(*out)


class DailyPipeline:
    def __init__(self, spark: SparkSession, sf_dir: str, out_root: str, now: str, buckets: int | None = None):
        self.spark, self.sf_dir, self.root, self.now = spark, sf_dir, out_root.rstrip("/"), now
        self.run_id = uuid.uuid4().hex[:10]
        self.feed = Feed(spark, sf_dir)
        self.buckets = buckets or B.buckets_for_rows(spark, self.feed.orders.count())
        self.results: list[StepResult] = []

    def _channel_rows(self, table: str, channel: str) -> DataFrame:
        bronze = getattr(self.feed, SIDE_BRONZE[table])()
        return bronze.filter(F.col("channel") == channel).select(*TABLE_COLUMNS[table])

    # extract -------------------------------------------------------------------------

    def extract_db(self, table: str) -> None:
        channel = DB_CHANNEL[table]
        rows = self._channel_rows(table, channel)
        B.write_bronze(rows, self.root, channel, table, "replace")

    def extract_sftp(self) -> None:
        landing = f"{self.root}/landing/sftp"
        for table in TABLES:
            CSV.write_csv_drop(_text(self._channel_rows(table, "sftp_drop")), landing, table, "20010801_020000000000")
            rows = canonicalize(CSV.read_csv_drops(self.spark, landing, table), table)
            B.write_bronze(rows, self.root, "sftp_drop", table, "replace")

    def extract_queue(self) -> None:
        log = f"{self.root}/landing/queue"
        topic_of = {t: topic for topic, t in TOPIC_TABLES.items()}
        for table in TABLES:
            msgs = queue_messages(_text(self._channel_rows(table, "kafka_drain")), topic_of[table])
            msgs.write.mode("overwrite").parquet(f"{log}/{table}")

        frozen = {topic: TABLE_SCHEMAS[table] for topic, table in TOPIC_TABLES.items()}

        def to_bronze(batch: DataFrame, key: str) -> None:
            check_messages(batch, frozen)
            for topic, table in TOPIC_TABLES.items():
                body = F.from_json("value", text_schema(table), {"mode": "FAILFAST"})
                rows = canonicalize(batch.filter(F.col("topic") == topic).select(body.alias("m")).select("m.*"), table)
                rows.write.parquet(f"{B.bronze_path(self.root, 'kafka_drain', table)}/batch={key}")

        def on_commit(document: dict, key: str) -> None:
            for table in TABLES:  # offsets and landed folders in one commit
                B.publish(document, "kafka_drain", table, f"batch={key}", TABLE_SCHEMAS[table], "append")

        commits = B.channel_log(self.spark, self.root, "kafka_drain")
        queue = LD.MessageLog(self.spark, log, f"{self.root}/state/kafka_drain/segments")
        LD.LedgerDrain(queue, commits, on_commit).run_with_retries(to_bronze)
        for table in TABLES:
            B.drop_unnamed(self.spark, self.root, "kafka_drain", table, commits)

    # promote / build ------------------------------------------------------------------------

    def promote_all(self) -> dict[str, DataFrame]:
        """Silver tables bucketed by transaction_id (same bucket count), so the
        build's full outer join reads both without a shuffle."""
        out = {}
        for table in TABLES:
            seen, kept = Observation(), Observation()
            bronze = B.read_bronze(self.spark, self.root, table).observe(seen, F.count(F.lit(1)).alias("n"))
            silver = promote(bronze, table).observe(kept, F.count(F.lit(1)).alias("n"))
            out[table] = B.write_bucketed(silver, B.silver_path(self.root, table),
                                          f"silver_{table}_{self.run_id}", buckets=self.buckets)
            self.results.append(StepResult("extract", table, seen.get["n"], "ok"))
            self.results.append(StepResult("promote", table, kept.get["n"], "ok"))
        return out

    def build(self, silver: dict[str, DataFrame]) -> Model:
        """Gold tables in the run's own folder, each written once; later tables read the written fact."""
        m = Model(self.spark, self.sf_dir, materialized=False)
        m.partner_silver = silver["partner_transactions"].select(*TABLE_COLUMNS["partner_transactions"])
        m.bank_silver = silver["bank_transactions"].select(*TABLE_COLUMNS["bank_transactions"])
        m.fact = self._write_gold("fct_transactions", m.fact, bucketed=True)
        m.current = self._write_gold("fct_transactions_current", m.current, bucketed=True)
        m._dim_values = self._write_gold("dimension_values", m._dim_values, record=False)
        for name in ("dim_partner", "dim_bank", "dim_decline_reason", "dim_date"):
            setattr(m, name, self._write_gold(name, getattr(m, name)))
        m.mart = self._write_gold("mart_transactions", m.mart, record=False)
        return m

    def _write_gold(self, name: str, df: DataFrame, record: bool = True, bucketed: bool = False) -> DataFrame:
        path, written = f"{self.root}/gold/runs/{self.run_id}/{name}", Observation()
        rows = df.observe(written, F.count(F.lit(1)).alias("n"))
        if bucketed:
            out = B.write_bucketed(rows, path, f"{name}_{self.run_id}", buckets=self.buckets)
        else:
            rows.write.parquet(path)
            out = self.spark.read.schema(df.schema).parquet(path)
        if record:
            self.results.append(StepResult("build", name, written.get["n"], "ok"))
        return out

    def publish(self) -> None:
        """Point readers at this run's gold: one appended row, the newest one counts."""
        (self.spark.range(1).select(F.lit(self.run_id).alias("run_id"), F.unix_micros(F.current_timestamp()).alias("published_at"))
         .coalesce(1).write.mode("append").parquet(f"{self.root}/gold/published"))

    def test_staging(self, silver: dict[str, DataFrame]) -> None:
        """The tests declared on staging, before anything is built from it."""
        staging = {f"stg_{table}": df for table, df in silver.items()}
        self._gate(Q.run_checks(staging, [spec for spec in S.DECLARED if spec.name in staging], S.STORED_BY))

    def test(self, m: Model) -> None:
        n = self._gate(S.declared_suite(m))
        self.results.append(StepResult("test", "declared_checks", n, "ok"))

    def _gate(self, checks: DataFrame) -> int:
        results = checks.select("model", "column_name", "test", "status").collect()  # one row per declared check
        failed = [r for r in results if r["status"] == "fail"]
        if failed:
            desc = ", ".join(f"{r['test']}({r['model']}.{r['column_name']})" for r in failed)
            raise PipelineFailed(f"{len(failed)} error-level data test(s) failed: {desc}; downstream steps not run")
        return len(results)

    def freshness(self, silver: dict[str, DataFrame]) -> None:
        for table, df in silver.items():
            r = Q.freshness(df, "updated_at", self.now).first()
            self.results.append(StepResult("freshness", table, 1, r["status"]))

    def run(self) -> DataFrame:
        self.extract_db("partner_transactions")
        self.extract_db("bank_transactions")
        self.extract_sftp()
        self.extract_queue()
        silver = self.promote_all()
        self.test_staging(silver)
        m = self.build(silver)
        self.test(m)
        self.publish()
        self.freshness(silver)
        schema = "step string, table_name string, rows bigint, status string"
        return self.spark.createDataFrame([(r.step, r.table_name, r.rows, r.status) for r in self.results], schema)


def read_gold(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """A gold table of the run published last."""
    root = out_root.rstrip("/")
    run_id = spark.read.parquet(f"{root}/gold/published").agg(F.max_by("run_id", "published_at")).first()[0]
    return spark.read.parquet(f"{root}/gold/runs/{run_id}/{name}")


def run_pipeline(spark: SparkSession, sf_dir: str, out_root: str, now: str) -> DataFrame:
    return DailyPipeline(spark, sf_dir, out_root, now).run()
