"""Deterministic two-sided transaction feed derived from the driver's ``orders`` table.

Every order becomes one transaction; its partner, bank, outcome, timestamps,
orphan side and bronze duplicates are arithmetic on (o_orderkey, o_custkey), so
the feed grows with ``orders`` and is identical in Spark and in DuckDB.

The Spark side is written with DataFrame expressions over one scan of
``orders`` (no self-join: duplicates are re-derived from the same row);
``DUCKDB_CTES`` is the same projection as SQL text for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.contracts import BANK_COLUMNS, DECLINE_REASONS, PARTNER_COLUMNS

# Fixed values of the fixture catalog (FIXTURES.md section B).
PARTNER_CYCLE = ("partner_acme", "partner_globex", "partner_initech",
                 "partner_umbrella", "partner_wonka", "partner_stark")
BANK_CYCLE = ("bank_chase", "bank_wells_fargo", "bank_citibank", "bank_goldman")
PARTNER_AUTH_PCT = (94, 90, 86, 80, 92, 95)
BANK_AUTH_ADJUST = (2, 0, -2, -4)
PARTNER_SETTLE_PCT = (97, 95, 93, 90, 96, 98)
DB_PARTNERS = ("partner_acme", "partner_umbrella")
SFTP_PARTNERS = ("partner_globex", "partner_wonka")
DB_BANKS = ("bank_chase", "bank_goldman")
SFTP_BANKS = ("bank_wells_fargo",)


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _sec(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n)


def load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def outcome(orders: DataFrame) -> DataFrame:
    """fx_outcome: one fully simulated transaction per order (both sides' truth).

    Two projections: the first computes the draws once per row, the second
    builds the columns from them (Catalyst keeps the split instead of
    duplicating the non-trivial terms into every column).
    """
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pi, bi = c % 6, (k * 7 + c) % 4
    draws = orders.select(
        k.alias("k"), c.alias("c"), F.col("o_orderdate").alias("d"), F.col("o_totalprice").alias("price"),
        pi.alias("pi"), bi.alias("bi"),
        ((k * 31 + c * 7) % 100 < _pick(PARTNER_AUTH_PCT, pi) + _pick(BANK_AUTH_ADJUST, bi)).alias("authorized"),
        ((k * 17 + c * 3) % 100 < _pick(PARTNER_SETTLE_PCT, pi)).alias("settle_ok"),
        (k % 25 == 0).alias("refund"),
        ((k * 13 + c) % 20).alias("r_orphan"),
        ((k * 11 + c) % 50).alias("r_dup"),
    ).withColumn("captured", F.col("authorized") & F.col("settle_ok"))
    k, d = F.col("k"), F.col("d")
    captured, authorized = F.col("captured"), F.col("authorized")
    base = k % 80000
    return draws.select(
        F.concat(F.lit("txn-"), k.cast("string")).alias("transaction_id"),
        _pick(PARTNER_CYCLE, F.col("pi")).alias("partner_id"),
        _pick(BANK_CYCLE, F.col("bi")).alias("bank_id"),
        F.round(F.col("price") * 100).cast("bigint").alias("amount_cents"),
        F.lit("USD").alias("currency"),
        F.when(~captured, "failed").when(F.col("refund"), "refunded").otherwise("settled").alias("state"),
        F.when(~captured, _pick(DECLINE_REASONS, (k + F.col("c")) % 4)).alias("decline_reason"),
        (d + _sec(base)).alias("initiated_at"),
        F.when(authorized, d + _sec(base + 1 + k % 30)).alias("authorized_at"),
        F.when(captured, d + _sec(base + 40 + k % 60)).alias("captured_at"),
        F.when(captured, d + _sec(base + 160 + 60 * (k % 90))).alias("settled_at"),
        F.when(~captured, d + _sec(base + 35 + k % 60)).alias("failed_at"),
        F.when(captured & F.col("refund"), d + _sec(base + 90000)).alias("refunded_at"),
        k, F.col("r_orphan"), F.col("r_dup"),
    )


_PARTNER_TS = ("initiated_at", "authorized_at", "captured_at", "settled_at", "failed_at", "refunded_at")


def _partner_rows(o: DataFrame, shift_seconds: int | str = 0) -> DataFrame:
    updated = F.greatest(*[F.col(c) for c in _PARTNER_TS])
    if isinstance(shift_seconds, str):
        updated = updated + _sec(F.col(shift_seconds))
    elif shift_seconds:
        updated = updated + _sec(F.lit(shift_seconds))
    return o.select(*[F.col(c) for c in PARTNER_COLUMNS[:-1]], updated.alias("updated_at"))


def _bank_rows(o: DataFrame, shift_seconds: int | str = 0) -> DataFrame:
    lag = _sec(F.col("k") % 6)
    updated = F.greatest(*[F.col(c) for c in _PARTNER_TS]) + lag
    if isinstance(shift_seconds, str):
        updated = updated + _sec(F.col(shift_seconds))
    elif shift_seconds:
        updated = updated + _sec(F.lit(shift_seconds))
    cols = []
    for c in BANK_COLUMNS[:-1]:
        cols.append((F.col(c) + lag).alias(c) if c.endswith("_at") else F.col(c))
    return o.select(*cols, updated.alias("updated_at"))


def _with_copies(o: DataFrame, again) -> DataFrame:
    """Each row once (_copy 0); rows matching ``again`` a second time (_copy 1),
    from the same scan."""
    copies = F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return o.withColumn("_copy", F.explode(copies))


def partner_feed(orders: DataFrame) -> DataFrame:
    """fx_partner: the partner's view; 5 % of transactions never reach it."""
    return _partner_rows(outcome(orders).filter(F.col("r_orphan") != 0))


def bank_feed(orders: DataFrame) -> DataFrame:
    """fx_bank: the bank's view (no initiated_at), 0-5 s later; another 5 % missing."""
    return _bank_rows(outcome(orders).filter(F.col("r_orphan") != 1))


def partner_channel(partner_id: Column) -> Column:
    return (F.when(partner_id.isin(*DB_PARTNERS), "partner_db")
             .when(partner_id.isin(*SFTP_PARTNERS), "sftp_drop")
             .otherwise("kafka_drain"))


def bank_channel(bank_id: Column) -> Column:
    return (F.when(bank_id.isin(*DB_BANKS), "bank_db")
             .when(bank_id.isin(*SFTP_BANKS), "sftp_drop")
             .otherwise("kafka_drain"))


def partner_bronze(orders: DataFrame) -> DataFrame:
    """fx_partner_bronze: every channel's rows, plus 2 % re-deliveries (updated_at + 1 s)
    on the file and queue channels."""
    o = outcome(orders).filter(F.col("r_orphan") != 0)
    again = (F.col("r_dup") == 0) & ~F.col("partner_id").isin(*DB_PARTNERS)
    both = _partner_rows(_with_copies(o, again), "_copy")
    return both.select(partner_channel(F.col("partner_id")).alias("channel"), *PARTNER_COLUMNS)


def bank_bronze(orders: DataFrame) -> DataFrame:
    """fx_bank_bronze: same construction from the bank's view, channel by bank."""
    o = outcome(orders).filter(F.col("r_orphan") != 1)
    again = (F.col("r_dup") == 0) & ~F.col("bank_id").isin(*DB_BANKS)
    both = _bank_rows(_with_copies(o, again), "_copy")
    return both.select(bank_channel(F.col("bank_id")).alias("channel"), *BANK_COLUMNS)


VERSION_COLUMNS = ("transaction_id", "partner_id", "amount_cents", "state",
                   "decline_reason", "captured_at", "settled_at", "updated_at")


def versions(orders: DataFrame) -> DataFrame:
    """fx_versions: latest partner rows plus an older 'initiated' version of 10 % of
    them; some older versions carry a decline_reason the latest one lacks."""
    o = outcome(orders).filter(F.col("r_orphan") != 0)
    latest = _partner_rows(o).select(*VERSION_COLUMNS)
    older = o.filter(F.col("k") % 10 == 0).select(
        "transaction_id", "partner_id", "amount_cents", F.lit("initiated").alias("state"),
        F.when(F.col("k") % 20 == 0, F.lit("technical_error")).alias("decline_reason"),
        F.lit(None).cast("timestamp_ntz").alias("captured_at"),
        F.lit(None).cast("timestamp_ntz").alias("settled_at"),
        F.col("initiated_at").alias("updated_at"),
    )
    return latest.unionByName(older)


def queue_messages(rows: DataFrame, topic: str) -> DataFrame:
    """Text rows of a table as messages of ``topic``, with offsets that ascend in the order of the rows."""
    return rows.select(
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"),
        F.col("updated_at").cast("timestamp_ntz").alias("timestamp"), F.lit(0).alias("timestampType"),
        F.col("transaction_id").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))


class Feed:
    """Lazy handles on one sf directory's fixture frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @property
    def orders(self) -> DataFrame:
        return load_orders(self.spark, self.sf_dir)

    def partner(self) -> DataFrame:
        return partner_feed(self.orders)

    def bank(self) -> DataFrame:
        return bank_feed(self.orders)

    def partner_bronze(self) -> DataFrame:
        return partner_bronze(self.orders)

    def bank_bronze(self) -> DataFrame:
        return bank_bronze(self.orders)

    def versions(self) -> DataFrame:
        return versions(self.orders)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


# ---------------------------------------------------------------------------
# DuckDB form of the same projection, inlined as CTEs by every oracle query.
# ---------------------------------------------------------------------------

DUCKDB_CTES = """
fx_base AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderdate,
    CASE o_custkey % 6 WHEN 0 THEN 'partner_acme' WHEN 1 THEN 'partner_globex' WHEN 2 THEN 'partner_initech'
         WHEN 3 THEN 'partner_umbrella' WHEN 4 THEN 'partner_wonka' ELSE 'partner_stark' END AS partner_id,
    CASE (o_orderkey * 7 + o_custkey) % 4 WHEN 0 THEN 'bank_chase' WHEN 1 THEN 'bank_wells_fargo'
         WHEN 2 THEN 'bank_citibank' ELSE 'bank_goldman' END AS bank_id,
    CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents,
    CASE o_custkey % 6 WHEN 0 THEN 94 WHEN 1 THEN 90 WHEN 2 THEN 86 WHEN 3 THEN 80 WHEN 4 THEN 92 ELSE 95 END
      + CASE (o_orderkey * 7 + o_custkey) % 4 WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 2 THEN -2 ELSE -4 END AS auth_pct,
    CASE o_custkey % 6 WHEN 0 THEN 97 WHEN 1 THEN 95 WHEN 2 THEN 93 WHEN 3 THEN 90 WHEN 4 THEN 96 ELSE 98 END AS settle_pct,
    (o_orderkey * 31 + o_custkey * 7) % 100 AS r_auth,
    (o_orderkey * 17 + o_custkey * 3) % 100 AS r_settle,
    (o_orderkey * 13 + o_custkey) % 20 AS r_orphan,
    (o_orderkey * 11 + o_custkey) % 50 AS r_dup,
    o_orderkey % 25 AS r_refund
  FROM orders),
fx_outcome AS (
  SELECT concat('txn-', CAST(k AS VARCHAR)) AS transaction_id, partner_id, bank_id, amount_cents, 'USD' AS currency,
    CASE WHEN r_auth >= auth_pct OR r_settle >= settle_pct THEN 'failed'
         WHEN r_refund = 0 THEN 'refunded' ELSE 'settled' END AS state,
    CASE WHEN r_auth >= auth_pct OR r_settle >= settle_pct THEN
         CASE (k + c) % 4 WHEN 0 THEN 'insufficient_funds' WHEN 1 THEN 'fraud_suspected'
              WHEN 2 THEN 'technical_error' ELSE 'invalid_account' END END AS decline_reason,
    o_orderdate + to_seconds(k % 80000) AS initiated_at,
    CASE WHEN r_auth < auth_pct THEN o_orderdate + to_seconds(k % 80000 + 1 + k % 30) END AS authorized_at,
    CASE WHEN r_auth < auth_pct AND r_settle < settle_pct THEN o_orderdate + to_seconds(k % 80000 + 40 + k % 60) END AS captured_at,
    CASE WHEN r_auth < auth_pct AND r_settle < settle_pct THEN o_orderdate + to_seconds(k % 80000 + 160 + 60 * (k % 90)) END AS settled_at,
    CASE WHEN r_auth >= auth_pct OR r_settle >= settle_pct THEN o_orderdate + to_seconds(k % 80000 + 35 + k % 60) END AS failed_at,
    CASE WHEN r_auth < auth_pct AND r_settle < settle_pct AND r_refund = 0 THEN o_orderdate + to_seconds(k % 80000 + 90000) END AS refunded_at,
    k, r_orphan, r_dup
  FROM fx_base),
fx_partner AS (
  SELECT transaction_id, partner_id, bank_id, amount_cents, currency, state, decline_reason,
    initiated_at, authorized_at, captured_at, settled_at, failed_at, refunded_at,
    greatest(initiated_at, authorized_at, captured_at, settled_at, failed_at, refunded_at) AS updated_at
  FROM fx_outcome WHERE r_orphan <> 0),
fx_bank AS (
  SELECT transaction_id, partner_id, bank_id, amount_cents, currency, state, decline_reason,
    authorized_at + to_seconds(k % 6) AS authorized_at, captured_at + to_seconds(k % 6) AS captured_at,
    settled_at + to_seconds(k % 6) AS settled_at, failed_at + to_seconds(k % 6) AS failed_at,
    refunded_at + to_seconds(k % 6) AS refunded_at,
    greatest(initiated_at, authorized_at, captured_at, settled_at, failed_at, refunded_at) + to_seconds(k % 6) AS updated_at
  FROM fx_outcome WHERE r_orphan <> 1),
fx_partner_bronze AS (
  SELECT CASE WHEN partner_id IN ('partner_acme','partner_umbrella') THEN 'partner_db'
              WHEN partner_id IN ('partner_globex','partner_wonka') THEN 'sftp_drop' ELSE 'kafka_drain' END AS channel, p.*
  FROM fx_partner p
  UNION ALL
  SELECT CASE WHEN p.partner_id IN ('partner_globex','partner_wonka') THEN 'sftp_drop' ELSE 'kafka_drain' END AS channel,
    p.transaction_id, p.partner_id, p.bank_id, p.amount_cents, p.currency, p.state, p.decline_reason, p.initiated_at,
    p.authorized_at, p.captured_at, p.settled_at, p.failed_at, p.refunded_at, p.updated_at + to_seconds(1) AS updated_at
  FROM fx_partner p JOIN fx_outcome o ON p.transaction_id = o.transaction_id
  WHERE o.r_dup = 0 AND p.partner_id NOT IN ('partner_acme','partner_umbrella')),
fx_bank_bronze AS (
  SELECT CASE WHEN bank_id IN ('bank_chase','bank_goldman') THEN 'bank_db'
              WHEN bank_id IN ('bank_wells_fargo') THEN 'sftp_drop' ELSE 'kafka_drain' END AS channel, b.*
  FROM fx_bank b
  UNION ALL
  SELECT CASE WHEN b.bank_id IN ('bank_wells_fargo') THEN 'sftp_drop' ELSE 'kafka_drain' END AS channel,
    b.transaction_id, b.partner_id, b.bank_id, b.amount_cents, b.currency, b.state, b.decline_reason,
    b.authorized_at, b.captured_at, b.settled_at, b.failed_at, b.refunded_at, b.updated_at + to_seconds(1) AS updated_at
  FROM fx_bank b JOIN fx_outcome o ON b.transaction_id = o.transaction_id
  WHERE o.r_dup = 0 AND b.bank_id NOT IN ('bank_chase','bank_goldman')),
fx_versions AS (
  SELECT transaction_id, partner_id, amount_cents, state, decline_reason, captured_at, settled_at, updated_at FROM fx_partner
  UNION ALL
  SELECT transaction_id, partner_id, amount_cents, 'initiated' AS state,
    CASE WHEN k % 20 = 0 THEN 'technical_error' END AS decline_reason,
    CAST(NULL AS TIMESTAMP) AS captured_at, CAST(NULL AS TIMESTAMP) AS settled_at, initiated_at AS updated_at
  FROM fx_outcome WHERE k % 10 = 0 AND r_orphan <> 0),
fee_schedule AS (
  SELECT * FROM (VALUES
    ('partner_acme','bank_chase',30,250), ('partner_acme','bank_wells_fargo',25,220),
    ('partner_acme','bank_citibank',35,260), ('partner_acme','bank_goldman',40,270),
    ('partner_globex','bank_chase',20,200), ('partner_globex','bank_wells_fargo',15,180),
    ('partner_globex','bank_citibank',25,210), ('partner_globex','bank_goldman',30,230),
    ('partner_initech','bank_chase',40,300), ('partner_initech','bank_wells_fargo',35,280),
    ('partner_initech','bank_citibank',45,310), ('partner_initech','bank_goldman',50,320),
    ('partner_umbrella','bank_chase',35,270), ('partner_umbrella','bank_wells_fargo',30,250),
    ('partner_umbrella','bank_citibank',40,290), ('partner_umbrella','bank_goldman',45,300),
    ('partner_wonka','bank_chase',25,230), ('partner_wonka','bank_wells_fargo',20,210),
    ('partner_wonka','bank_citibank',30,240), ('partner_wonka','bank_goldman',35,260),
    ('partner_stark','bank_chase',15,190), ('partner_stark','bank_wells_fargo',10,170),
    ('partner_stark','bank_citibank',20,200), ('partner_stark','bank_goldman',25,220)
  ) AS t(partner_id, bank_id, fixed_fee_cents, percentage_bps))
"""


def with_fixture(body: str, *extra_ctes: str) -> str:
    """Prefix an oracle query with the fixture CTEs (plus optional query CTEs)."""
    ctes = DUCKDB_CTES.strip()
    for e in extra_ctes:
        ctes += ",\n" + e.strip()
    return f"WITH {ctes}\n{body.strip()}"
