"""Row canonicalisation, the identifier guard and the schema contract.

All three run as column expressions / one aggregation, before anything is
written: a failing batch leaves nothing behind.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settlekit.contracts import TABLE_SCHEMAS, TIMESTAMP_FIELDS
from settlekit.functions.columns import blank_to_null, has_digit_run


class IdentifierGuardError(ValueError):
    """A string field carries a standalone 13-19 digit run: the batch is refused."""


class SchemaDriftError(ValueError):
    """A source added or retyped a column against the frozen contract."""


def canonicalize(df: DataFrame, table: str) -> DataFrame:
    """Transport text -> contract types, in one projection.

    '' and NULL -> NULL; timestamp fields parse ISO-8601 to TIMESTAMP_NTZ, a UTC
    offset in the text is converted to UTC wall time;
    amount_cents -> BIGINT; other fields unchanged. A value that does not
    parse fails the batch with an error naming the field (in any ANSI mode),
    instead of turning into NULL. Contract columns
    the source does not send are NULL (missing columns are tolerated); columns
    outside the contract are kept for the contract check to judge.
    """
    schema = TABLE_SCHEMAS[table]
    present = set(df.columns)
    out = []
    for f in schema.fields:
        if f.name not in present:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name)
        if isinstance(df.schema[f.name].dataType, T.StringType):
            c = blank_to_null(c)
        if f.name in TIMESTAMP_FIELDS or f.name == "amount_cents":
            c = _strict_cast(c, f.name, "timestamp_ntz" if f.name in TIMESTAMP_FIELDS else "bigint")
        out.append(c.alias(f.name))
    extra = [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*out, *extra)


def _wall_time(c):
    """Text with a UTC offset (or Z) -> TIMESTAMP_NTZ of the same instant in UTC; without
    one, the wall time as it is. NULL where it does not parse, in any session zone."""
    instant = F.timestamp_add("MICROSECOND", F.unix_micros(c.try_cast("timestamp")),
                              F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    # cheap tests before the pattern: a sign after the date, or a time without a date
    maybe = c.endswith("Z") | c.endswith("z") | c.contains("+") | F.substring(c, 11, 64).contains("-") | (F.substring(c, 3, 1) == ":")
    return F.when(maybe & c.rlike(r"\d\d:\d\d.*([Zz]|[+-]\d\d(:?\d\d)?)$"), instant).otherwise(c.try_cast("timestamp_ntz"))


def _strict_cast(c, name: str, to: str):
    """Cast that fails the batch on a value that does not parse, naming the
    field, whatever the session's ANSI setting."""
    parsed = _wall_time(c.cast("string")) if to == "timestamp_ntz" else c.try_cast(to)
    bad = F.raise_error(F.concat(F.lit(f"field '{name}' has a value that is not a valid {to}: "),
                                 c.cast("string")))
    return F.coalesce(parsed, F.when(c.isNotNull(), bad))  # parsed once a value


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def digit_run_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One aggregation: per string column, rows with a standalone 13-19 digit run.
    Returns (column_name, matches), one row per column."""
    cols = list(columns) if columns is not None else string_columns(df)
    agg = df.agg(*[F.count_if(has_digit_run(c)).alias(f"_m{i}") for i, c in enumerate(cols)])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("matches"))
        for i, c in enumerate(cols)])).alias("r")).select("r.*")


def guard_identifiers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Refuse the whole batch if any string field carries a card-like digit run.

    One aggregation job; only the per-column counts reach the driver. Returns
    ``df`` unchanged when clean, raises ``IdentifierGuardError`` naming the
    first offending field otherwise.
    """
    cols = list(columns) if columns is not None else string_columns(df)
    if not cols:
        return df
    row = df.agg(*[F.count_if(has_digit_run(c)).alias(f"_m{i}") for i, c in enumerate(cols)]).first()
    for i, c in enumerate(cols):
        if row[f"_m{i}"]:
            raise IdentifierGuardError(
                f"column '{c}': {row[f'_m{i}']} row(s) hold an unmasked number of 13 to 19 digits; "
                "nothing of this batch is loaded")
    return df


# --- schema contract ---------------------------------------------------------------------

@dataclass(frozen=True)
class Drift:
    column_name: str
    kind: str            # new_column | type_changed | missing_ok
    frozen_type: str | None
    observed_type: str | None


def schema_drift(frozen: T.StructType, observed: T.StructType) -> list[Drift]:
    """Columns frozen, data types frozen, missing columns tolerated."""
    f = {x.name: x.dataType for x in frozen.fields}
    o = {x.name: x.dataType for x in observed.fields}
    out = [Drift(n, "new_column", None, o[n].simpleString()) for n in o if n not in f]
    out += [Drift(n, "type_changed", f[n].simpleString(), o[n].simpleString())
            for n in o if n in f and f[n] != o[n]]
    out += [Drift(n, "missing_ok", f[n].simpleString(), None) for n in f if n not in o]
    return out


def drift_report(frozen: T.StructType, observed: dict[str, DataFrame]) -> DataFrame:
    """Contract comparison of several sources, with the rows each drift affects.

    Per source ONE aggregation: non-NULL values of every new or retyped
    column and the row count (a missing column affects every row); the drift
    metadata rides along as literals. Sources without drift contribute no rows.
    """
    out = None
    for source, df in observed.items():
        drifts = schema_drift(frozen, df.schema)
        if not drifts:
            continue
        aggs = [F.count(F.lit(1)).alias("_rows")]
        aggs += [F.count(F.col(d.column_name)).alias(f"_n{i}") for i, d in enumerate(drifts) if d.kind != "missing_ok"]
        counts = df.agg(*aggs)
        entries = [F.struct(
            F.lit(d.column_name).alias("column_name"), F.lit(d.kind).alias("kind"),
            F.lit(d.frozen_type).cast("string").alias("frozen_type"),
            F.lit(d.observed_type).cast("string").alias("observed_type"),
            F.lit(d.kind != "missing_ok").alias("violation"),
            (F.col("_rows") if d.kind == "missing_ok" else F.col(f"_n{i}")).alias("rows_affected"))
            for i, d in enumerate(drifts)]
        one = counts.select(F.explode(F.array(*entries)).alias("d")).select(F.lit(source).alias("source"), "d.*")
        out = one if out is None else out.unionByName(one)
    return out


def enforce_contract(df: DataFrame, frozen: T.StructType, source: str = "source") -> DataFrame:
    """Raise ``SchemaDriftError`` on a new or retyped column; return ``df`` otherwise."""
    bad = [d for d in schema_drift(frozen, df.schema) if d.kind != "missing_ok"]
    if bad:
        desc = ", ".join(f"{d.kind}:{d.column_name}" for d in bad)
        raise SchemaDriftError(f"schema contract violated by {source} (columns and types are frozen): {desc}")
    return df


def check_messages(messages: DataFrame, frozen: dict[str, T.StructType]) -> DataFrame:
    """Contract and identifier guard over JSON message bodies, whatever fields they carry.

    ``messages`` has ``topic`` and ``value``, ``frozen`` the contract of each topic. Every
    key of every body is held against the topic's contract and every value is scanned,
    before anything is projected away. One aggregation; raises or returns ``messages``.
    """
    body = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    known = F.lit(None).cast("array<string>")
    for topic, schema in frozen.items():
        known = F.when(F.col("topic") == topic, F.array(*map(F.lit, schema.names))).otherwise(known)
    rows = messages.select("topic", body.alias("body"), known.alias("known"))
    extra = F.when(F.col("known").isNotNull(), F.array_except(F.map_keys("body"), "known"))
    digits = F.map_keys(F.map_filter("body", lambda _, v: has_digit_run(F.coalesce(v, F.lit("")))))
    found = rows.select("topic", extra.alias("extra"), digits.alias("digits")).agg(
        F.min(F.when(F.size("extra") > 0, F.concat_ws(":", "topic", F.array_min("extra")))).alias("extra"),
        F.min(F.when(F.size("digits") > 0, F.concat_ws(":", "topic", F.array_min("digits")))).alias("digits")).first()
    if found["extra"]:
        raise SchemaDriftError(f"message field outside the frozen contract: {found['extra']}")
    if found["digits"]:
        raise IdentifierGuardError(f"message field '{found['digits']}' holds an unmasked number of 13 to 19 digits; nothing of this batch is loaded")
    return messages
