"""Data-quality checks. Each check returns its failing rows (a check passes when
it returns none); the suite runs many checks per table in one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlekit.functions.columns import has_digit_run

# --- single checks (failing rows) ---------------------------------------------------


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once (NULLs ignored), with their count."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Values outside the accepted set (NULL passes), with their count."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values)).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, col: str, parent: DataFrame, field_: str) -> DataFrame:
    """Non-NULL child keys without a parent row (NULL keys are exempt)."""
    parents = parent.select(F.col(field_).alias(col)).distinct()
    return child.filter(F.col(col).isNotNull()).join(parents, col, "left_anti").select(col)


def no_digit_run(df: DataFrame, col: str) -> DataFrame:
    """Rows whose value carries a standalone 13-19 digit run."""
    return df.filter(has_digit_run(col))


def freshness(df: DataFrame, ts_col: str, now: str, warn_hours: float = 4,
              error_hours: float = 8) -> DataFrame:
    """One row: newest ``ts_col``, its age at ``now`` in hours, and pass/warn/error.
    A newest value ahead of ``now`` (negative age) passes."""
    now_ts = F.lit(now).cast("timestamp_ntz")
    newest = df.agg(F.max(ts_col).alias("max_loaded_at"))
    # NTZ arithmetic: independent of the session time zone.
    age_h = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), now_ts) / 3.6e9
    return newest.select(
        "max_loaded_at", now_ts.alias("snapshotted_at"), F.round(age_h, 6).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), "error")
         .when(age_h > error_hours, "error").when(age_h > warn_hours, "warn").otherwise("pass").alias("status"))


# --- suite ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    kind: str                      # not_null | unique | accepted_values | no_digit_run | relationships
    column: str
    values: tuple = ()
    parent: str | None = None      # relationships: parent model name
    parent_field: str | None = None
    severity: str = "error"


@dataclass
class ModelChecks:
    name: str
    checks: list[Check] = field(default_factory=list)


ROW_CHECKS = ("not_null", "accepted_values", "no_digit_run")


def _row_predicate(c: Check) -> Column:
    col = F.col(c.column)
    if c.kind == "not_null":
        return col.isNull()
    if c.kind == "accepted_values":
        return col.isNotNull() & ~col.isin(*c.values)
    if c.kind == "no_digit_run":
        return has_digit_run(c.column)
    raise ValueError(c.kind)


def _entry(check_id: int, value, child: int, parent: int):
    return F.struct(F.lit(check_id).alias("check_id"), value.cast("string").alias("value"),
                    F.lit(child).cast("int").alias("child"), F.lit(parent).cast("int").alias("parent"))


def run_checks(models: dict[str, DataFrame], specs: Sequence[ModelChecks], stored_by: dict[str, str] | None = None) -> DataFrame:
    """Every declared check -> (model, column_name, test, failures, severity, status).

    Each model is scanned ONCE: every row emits, through one ``explode``, an
    entry per check it concerns -- a failing row-level check (not_null,
    accepted_values, no_digit_run), its non-NULL value for ``unique``, its
    non-NULL key for ``relationships`` -- and each relationship's parent
    contributes its distinct keys. One aggregation by (check id, value),
    partial on the map side, then gives failing rows, values seen more than
    once, and child rows whose key no parent has. ``stored_by`` names the column that
    a model is bucketed by: its uniqueness is counted inside the buckets from that one
    column, so the keys are not shuffled. The check list itself (one
    row per declared check, bounded by the suite) supplies the names and a
    zero row for checks without failures.
    """
    checks = [(spec.name, c) for spec in specs for c in spec.checks]
    in_buckets = [c.kind == "unique" and (stored_by or {}).get(name) == c.column for name, c in checks]
    streams: list[DataFrame] = []
    i = 0
    for spec in specs:
        entries = []
        for c in spec.checks:
            col = F.col(c.column)
            if c.kind in ROW_CHECKS:
                entries.append(F.when(_row_predicate(c), _entry(i, F.lit(None), 1, 0)))
            elif in_buckets[i]:
                streams.append(unique(models[spec.name], c.column).select(_entry(i, F.lit(None), 1, 0).alias("e")))
            else:  # unique, relationships: the non-NULL value itself
                entries.append(F.when(col.isNotNull(), _entry(i, col, 1, 0)))
            if c.kind == "relationships":
                parent_keys = models[c.parent].select(F.col(c.parent_field).alias("_k")).distinct()
                streams.append(parent_keys.select(_entry(i, F.col("_k"), 0, 1).alias("e")))
            i += 1
        if entries:
            streams.append(models[spec.name].select(F.explode(F.array(*entries)).alias("e")).filter(F.col("e").isNotNull()))
    allrows = streams[0]
    for st in streams[1:]:
        allrows = allrows.unionByName(st)
    kinds = ["unique_in_buckets" if here else c.kind for (_, c), here in zip(checks, in_buckets, strict=True)]
    kind = F.element_at(F.array(*map(F.lit, kinds)), F.col("check_id") + 1)
    per_value = (allrows.select("e.*").groupBy("check_id", "value")
                 .agg(F.sum("child").alias("n_child"), F.max("parent").alias("has_parent")))
    failing = (F.when(kind == "unique", F.when(F.col("n_child") > 1, 1).otherwise(0))
                .when(kind == "relationships", F.when(F.col("has_parent") == 0, F.col("n_child")).otherwise(0))
                .otherwise(F.col("n_child")))
    counts = per_value.groupBy("check_id").agg(F.sum(failing).cast("bigint").alias("failures"))
    spark = next(iter(models.values())).sparkSession
    meta = spark.createDataFrame([(j, m, c.column, c.kind, c.severity) for j, (m, c) in enumerate(checks)],
                                 "check_id int, model string, column_name string, test string, severity string")
    out = F.broadcast(meta).join(counts, "check_id", "left")
    return out.select("model", "column_name", "test", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
                      "severity").withColumn(
        "status", F.when(F.col("failures") == 0, "pass")
                   .otherwise(F.when(F.col("severity") == "warn", "warn").otherwise("fail")))


def freshness_results(tables: dict[str, DataFrame], ts_col: str, now: str, warn_hours: float = 4,
                      error_hours: float = 8) -> DataFrame:
    """Freshness of several tables as suite result rows (test 'freshness';
    status pass / warn / error, failures 1 when not passing)."""
    out = None
    for name, df in tables.items():
        one = freshness(df, ts_col, now, warn_hours, error_hours).select(
            F.lit(name).alias("model"), F.lit(ts_col).alias("column_name"), F.lit("freshness").alias("test"),
            F.when(F.col("status") == "pass", 0).otherwise(1).cast("bigint").alias("failures"),
            F.when(F.col("status") == "error", "error").otherwise("warn").alias("severity"), "status")
        out = one if out is None else out.unionByName(one)
    return out


def severity_rollup(results: DataFrame) -> DataFrame:
    """Alert level per result: a failed error-level check or a freshness error
    -> critical; a warn-level failure or a freshness warning -> warning;
    counted per level."""
    level = (F.when(F.col("status").isin("fail", "error"), "critical")
              .when(F.col("status") == "warn", "warning").otherwise("ok"))
    return (results.groupBy(level.alias("alert_level"))
                   .agg(F.count(F.lit(1)).alias("checks"), F.sum("failures").cast("bigint").alias("failing_rows")))
