"""File listing for landing folders and versioned tables.

Local paths are listed with the standard library; any other store (HDFS,
object stores) through Spark's own file index (``binaryFile`` source with
only the ``path`` column selected, so no file content is read).
"""

from __future__ import annotations

import glob as _glob
import os
from urllib.parse import urlparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def local_path(path: str, spark: SparkSession) -> str | None:
    """The path on local disk, if that is where it lies; without a scheme the session's default store decides."""
    u = urlparse(path)
    scheme = u.scheme or urlparse(spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")).scheme
    return u.path if scheme == "file" else None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the store it names (without a scheme: the session's default one)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def fingerprint(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Files, bytes and newest change below a path: differs once its data was written again."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True)
    n = size = newest = 0
    while found.hasNext():
        status = found.next()
        n, size, newest = n + 1, size + status.getLen(), max(newest, status.getModificationTime())
    return n, size, newest


def list_files(spark: SparkSession, root: str, name_glob: str = "*") -> list[str]:
    """All data files below ``root`` (recursively) whose file name matches ``name_glob``."""
    local = local_path(root, spark)
    if local is not None:
        found = _glob.glob(os.path.join(local, "**", name_glob), recursive=True)
        return sorted(f for f in found if os.path.isfile(f) and not os.path.basename(f).startswith(("_", ".")))
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", name_glob).load(root).select("path"))
    return sorted(r["path"] for r in df.collect())


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """First line of every file. Local files are opened directly; remote ones
    are read in ONE Spark job: within the split that starts at offset 0, the
    row read first (lowest position) is the file's first line."""
    out = {p: first_line(spark, p) for p in paths if local_path(p, spark) is not None}
    remote = [p for p in paths if local_path(p, spark) is None]
    if remote:
        lines = (spark.read.text(remote)
                 .select(F.col("_metadata.file_path").alias("path"), "value",
                         F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("pos"))
                 .filter(F.col("block") == 0)
                 .groupBy("path").agg(F.min_by("value", "pos").alias("line")))
        found = {_key(r["path"]): r["line"] for r in lines.collect()}   # one row per file
        for p in remote:
            out[p] = found.get(_key(p), "")
    return out


def _key(path: str) -> tuple[str, str, str]:
    """(scheme, authority, path): equal for spellings of one file (file:/x, file:///x)."""
    u = urlparse(path)
    scheme = u.scheme or "file"
    return scheme, ("" if scheme == "file" else u.netloc), u.path


def first_line(spark: SparkSession, path: str) -> str:
    local = local_path(path, spark)
    if local is not None:
        with open(local, encoding="utf-8", newline="") as fh:
            return fh.readline()
    return spark.read.text(path).first()["value"]
