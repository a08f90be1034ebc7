"""Column-expression helpers (all built-in Spark functions, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from settlekit.contracts import DIGIT_RUN_PATTERN


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch() -> Column:
    """1970-01-01 00:00:00 as TIMESTAMP_NTZ (timestamps are UTC wall time)."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def surrogate_key(c: str | Column) -> Column:
    """Deterministic 60-bit BIGINT key of a natural key: first 15 hex digits of md5.

    Stable across rebuilds without sequence state, never negative, and
    computable by any engine that has md5 (DuckDB: ('0x'||substr(md5(k),1,15))::BIGINT).
    """
    return F.conv(F.substring(F.md5(col_of(c).cast("string")), 1, 15), 16, 10).cast("bigint")


def fee_at_capture(amount_cents: str | Column, fixed_fee_cents: str | Column,
                   percentage_bps: str | Column) -> Column:
    """fixed + round_half_even(amount * bps / 10000) as BIGINT.

    The divisor is a double literal: the product is computed in floating point
    and rounded half-to-even, like the warehouse's Float64 round.
    """
    pct = col_of(amount_cents) * col_of(percentage_bps) / F.lit(10000.0)
    return col_of(fixed_fee_cents) + F.bround(pct, 0).cast("bigint")


def has_digit_run(c: str | Column) -> Column:
    """True when the value (as text) carries a standalone 13-19 digit run."""
    return col_of(c).cast("string").rlike(DIGIT_RUN_PATTERN)


def blank_to_null(c: str | Column) -> Column:
    """'' -> NULL, everything else unchanged."""
    return F.nullif(col_of(c), F.lit(""))


def iso_text(c: str | Column) -> Column:
    """TIMESTAMP_NTZ -> ISO-8601 text ('T' separator), without the session time
    zone (``date_format`` would shift wall times inside a DST gap)."""
    return F.regexp_replace(col_of(c).cast("string"), " ", "T")


def truncate_ntz(c: str | Column, unit: str) -> Column:
    """Truncate a TIMESTAMP_NTZ to ``unit`` and stay TIMESTAMP_NTZ, without the
    session time zone (``date_trunc`` would return a zoned TIMESTAMP)."""
    c = col_of(c)
    if unit == "hour":
        return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))
    d = F.to_date(c)
    if unit != "day":
        d = F.trunc(d, unit)
    return d.cast("timestamp_ntz")


# Calendar attributes ------------------------------------------------------------

def date_key(d: str | Column) -> Column:
    """yyyymmdd as INT."""
    d = col_of(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day_of_week(d: str | Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(col_of(d)) + 1).cast("int")


def week_start(d: str | Column) -> Column:
    """Monday of the week containing d, as DATE."""
    return F.trunc(col_of(d), "week")


def month_start(d: str | Column) -> Column:
    return F.trunc(col_of(d), "MM")
