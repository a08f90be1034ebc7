"""Join helpers: broadcast only behind a measured size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lookup sides above this many bytes are joined by shuffle instead of broadcast.
BROADCAST_MAX_BYTES = 64 << 20
# What a text or binary value counts for where only the number of rows is known.
TEXT_BYTES = 256


def _varying(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]


def _fixed_bytes(df: DataFrame) -> int:
    return 8 + sum(16 for f in df.schema.fields)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows: one aggregation, partial on every task."""
    size = F.lit(_fixed_bytes(df))
    for c in _varying(df):
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    return df.agg(F.sum(size.cast("long"))).first()[0] or 0


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES,
                      known_rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only if it provably holds at most ``max_bytes``.

    The size is measured, not assumed; ``known_rows`` passes a row count measured
    elsewhere (one aggregate for many narrow sides, or a literal table's length).
    A larger side is returned unmarked and Spark shuffles it (AQE may still
    demote to a broadcast from runtime statistics).
    """
    n = measured_bytes(df) if known_rows is None else known_rows * (_fixed_bytes(df) + TEXT_BYTES * len(_varying(df)))
    return F.broadcast(df) if n <= max_bytes else df
