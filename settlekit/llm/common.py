"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pieces that a group which may be hot is dealt into before it is reduced.
SALTS = 64
#: Classes that a model learns at most: the commonest ones.
MAX_CLASSES = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def salt(key: str | Column, pieces: int = SALTS) -> Column:
    """Piece of a hot group that a row belongs to, from the row's own key."""
    return F.pmod(F.xxhash64(F.lit(17), F.col(key) if isinstance(key, str) else key), F.lit(pieces)).cast("int")


def crc_bucket(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``: the fixed folds of the labelled rows."""
    return F.coalesce(F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % modulus, F.lit(0))


def bounded_sample(rows: DataFrame, by: str, key: str, per_class: int) -> tuple[list, dict]:
    """About ``per_class`` rows of each class of ``by`` (all, if fewer), collected; and the size of each class.

    Rows are taken by a hash of the whole key at a rate set by the class's own
    count, so the sample is uniform and the same for the same rows; a key that
    repeats without bound cannot make it larger than four times its due (rows of
    the smallest hashes stay, ties by their other columns). Of more than
    ``MAX_CLASSES`` classes the commonest are sampled.
    """
    sizes = rows.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by).limit(MAX_CLASSES)
    counts = {r[by]: r["n"] for r in sizes.collect()}
    if not counts:
        return [], {}
    draw = F.pmod(F.xxhash64(F.lit(29), F.col(key)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rate = F.lit(0.0)
    for value, n in counts.items():
        rate = F.when(F.col(by).eqNullSafe(F.lit(value)), F.lit(min(1.0, per_class / n))).otherwise(rate)
    taken = rows.withColumn("__draw", draw).filter(F.col("__draw") < rate)
    found = taken.orderBy("__draw", *rows.columns).limit(4 * per_class * len(counts) + 1000).collect()
    return sorted(found, key=lambda r: (str(r[by]), r["__draw"])), counts


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back.

    Cuts lineage like a checkpoint; the copy has no partitioning of its own, so a
    join with it exchanges both sides and Spark can split a hot key of the other side.
    """
    from ..session import scratch_folder

    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_group_min(rows: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``rows`` with the smallest ``value`` of their ``key``; a key that many rows share is dealt into pieces."""
    keyed = rows.withColumn("__piece", salt(value))
    parts = keyed.groupBy(key, "__piece").agg(F.min(value).alias("__least"))
    least = parts.groupBy(key).agg(F.min("__least").alias(out))
    back = parts.select(key, "__piece").join(least, key).select(F.col(key).alias("__key"), F.col("__piece").alias("__of"), out)
    return keyed.join(back, (keyed[key] == back["__key"]) & (keyed["__piece"] == back["__of"])).drop("__piece", "__key", "__of")
