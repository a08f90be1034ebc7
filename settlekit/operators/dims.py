"""Conformed dimensions: partner, bank, decline reason, calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.functions.columns import (date_key, iso_day_of_week, month_start,
                                         surrogate_key, week_start)


DATE_DIM_COLUMNS = ("date_key", "date_day", "day_of_week", "is_weekend", "week_start",
                    "iso_week", "month_start", "month", "quarter", "year")


def _calendar(days: DataFrame) -> DataFrame:
    d = F.col("date_day")
    return days.select(
        date_key(d).alias("date_key"), d,
        iso_day_of_week(d).alias("day_of_week"),
        (iso_day_of_week(d) >= 6).alias("is_weekend"),
        week_start(d).alias("week_start"),
        F.weekofyear(d).alias("iso_week"),
        month_start(d).alias("month_start"),
        F.month(d).alias("month"), F.quarter(d).alias("quarter"), F.year(d).alias("year"),
    )


def dim_date(spark: SparkSession, start: str | dt.date, n_days: int) -> DataFrame:
    """Calendar of ``n_days`` days from ``start`` (the warehouse default: 2025-01-01, 1096)."""
    start_lit = F.lit(str(start)).cast("date")
    days = spark.range(n_days).select(F.date_add(start_lit, F.col("id").cast("int")).alias("date_day"))
    return _calendar(days)


def activity_day(df: DataFrame):
    """The calendar day of a fact row: initiated day, else last update day."""
    return F.to_date(F.coalesce(F.col("initiated_at"), F.col("updated_at")))


DIMENSION_SOURCES = {
    "partner": ("partner_id",),
    "bank": ("bank_id",),
    "decline_reason": ("decline_reason", "bank_decline_reason"),
}


def dimension_values(fact: DataFrame, with_days: bool = True) -> DataFrame:
    """Every dimension's natural keys from ONE scan of the fact: (dim, value).

    Each row contributes its partner, bank, both decline reasons (and its
    activity day, ISO text) through a single ``explode``; one DISTINCT (partial
    per map task) reduces them. The result has one row per distinct key, so it
    is as small as the dimensions (days: bounded by the calendar span).
    """
    entries = [F.struct(F.lit(dim).alias("dim"), F.col(c).cast("string").alias("value"))
               for dim, cols in DIMENSION_SOURCES.items() for c in cols]
    if with_days:
        entries.append(F.struct(F.lit("day").alias("dim"), activity_day(fact).cast("string").alias("value")))
    keyed = fact.select(F.explode(F.array(*entries)).alias("e")).select("e.dim", "e.value")
    return keyed.filter(F.col("value").isNotNull()).distinct()


def dimension_from_values(values: DataFrame, dim: str) -> DataFrame:
    key, natural = f"{dim}_key", f"{dim}_id" if dim in ("partner", "bank") else dim
    return (values.filter(F.col("dim") == dim)
                  .select(surrogate_key("value").alias(key), F.col("value").alias(natural)))
