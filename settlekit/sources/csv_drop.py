"""CSV drops: ``{table}_*.csv`` files (or ``{table}_*`` folders of part files
written by Spark) with a header, columns matched BY NAME.

Files of one feed may come with different column orders. Each drop's header
line is read (first line only), drops are grouped by header, and each group
is read by Spark's CSV reader with an all-string schema in that group's order
and ``enforceSchema=False`` (Spark re-checks every file's header against it;
the default would map columns by position and silently swap reordered ones).
The groups are then unioned by name. Headers are also the place to catch a
drifted contract before any data is read.
"""

from __future__ import annotations

import csv
import io
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from settlekit.contracts import TABLE_SCHEMAS
from settlekit.operators.canonical import SchemaDriftError, schema_drift
from settlekit.sources.fs import first_line, first_lines, list_files

CSV_OPTIONS = {"encoding": "UTF-8", "mode": "FAILFAST", "enforceSchema": "false",
               "nullValue": "", "emptyValue": ""}


def drop_entries(spark: SparkSession, folder: str, table: str) -> dict[str, list[str]]:
    """Drops of ``table`` below ``folder``: entry name -> its CSV files."""
    root = folder.rstrip("/")
    out: dict[str, list[str]] = defaultdict(list)
    for f in list_files(spark, root, "*.csv"):
        rel = f.split(root.split(":", 1)[-1].rstrip("/") + "/", 1)[-1]
        entry = rel.split("/", 1)[0]
        if entry.startswith(f"{table}_"):
            out[entry].append(f)
    return dict(out)


def parse_header(line: str) -> tuple[str, ...]:
    return tuple(next(csv.reader(io.StringIO(line)))) if line.strip() else ()


def read_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    return parse_header(first_line(spark, path))


def read_csv_drops(spark: SparkSession, folder: str, table: str, check_contract: bool = True) -> DataFrame:
    """All drops of ``table`` as all-string columns named from each drop's header."""
    entries = drop_entries(spark, folder, table)
    if not entries:
        raise FileNotFoundError(f"no {table}_* drops in {folder}")
    # Headers of all files at once (one job for remote stores); a drop's header
    # is its first non-empty part file's first line.
    heads = first_lines(spark, [f for files in entries.values() for f in files])
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for files in entries.values():
        header = next((h for h in (parse_header(heads[f]) for f in files) if h), ())
        if header:
            groups[header].extend(files)
    frozen = TABLE_SCHEMAS[table]
    out = None
    for header, paths in groups.items():
        if check_contract:
            observed = T.StructType([T.StructField(c, frozen[c].dataType if c in frozen.names else T.StringType())
                                     for c in header])
            bad = [d for d in schema_drift(frozen, observed) if d.kind == "new_column"]
            if bad:
                raise SchemaDriftError(f"schema contract violated by csv drop {paths[0]}: "
                                       + ", ".join(f"new_column:{d.column_name}" for d in bad))
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
        df = spark.read.options(**CSV_OPTIONS).csv(paths, header=True, schema=schema)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def write_csv_drop(df: DataFrame, folder: str, table: str, stamp: str, columns=None) -> str:
    """Write ``df`` as one drop of ``table``: folder ``{table}_{stamp}`` of CSV
    part files with header (timestamps ISO-8601 with microseconds, NULL as '')."""
    cols = list(columns) if columns is not None else df.columns
    path = f"{folder.rstrip('/')}/{table}_{stamp}"
    (df.select(*cols).write.mode("overwrite")
       .option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
       .option("nullValue", "").option("emptyValue", "").csv(path))
    return path
