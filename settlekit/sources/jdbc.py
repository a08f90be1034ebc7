"""Full-refresh snapshot of a database table over JDBC, in slices read in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def snapshot_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
                  lower_bound: int | str | None = None, upper_bound: int | str | None = None,
                  num_partitions: int | None = None, fetch_size: int = 10000,
                  properties: dict[str, str] | None = None, predicates: Sequence[str] | None = None) -> DataFrame:
    """Read ``table`` in slices, one query and one task each: range slices of a numeric, date
    or timestamp ``partition_column`` between its bounds, or one slice per entry of
    ``predicates`` (SQL conditions that cover the table without overlap; for tables
    with nothing but a text key). With neither it is one query."""
    if predicates is not None:
        if partition_column is not None:
            raise ValueError("slices come from a partition column or from predicates, not both")
        return spark.read.jdbc(url, table, predicates=list(predicates),
                               properties={"fetchsize": str(fetch_size), **(properties or {})})
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", str(fetch_size)))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            raise ValueError(f"slices of {partition_column} need a lower and an upper bound")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 8)))
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
               properties: dict[str, str] | None = None) -> None:
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
