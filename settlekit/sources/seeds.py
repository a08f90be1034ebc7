"""Typed seeds (small reference tables shipped with the code)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from settlekit.contracts import FEE_SCHEDULE_ROWS, FEE_SCHEMA


def fee_schedule(spark: SparkSession) -> DataFrame:
    """The fee seed as a typed DataFrame (partner x bank, INT fee columns)."""
    return spark.createDataFrame(list(FEE_SCHEDULE_ROWS), schema=FEE_SCHEMA)


def read_seed_csv(spark: SparkSession, path: str, schema=FEE_SCHEMA) -> DataFrame:
    """A seed CSV with header, read with an explicit schema (never inferred)."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False, mode="FAILFAST")
