"""Rows that every operator over documents has to stand."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    """documents with the given (doc_id, text) rows and extra columns whose names the operators use inside."""
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    for name in ("digest", "piece", "key", "id", "n", "kind", "start", "row", "score", "copies", "rate", "tokens", "bands", "root", "value"):
        df = df.withColumn(name, F.lit(name))
    return df


#: Null and empty texts, a null id, a long text without white space, ties, repeated rows, odd characters.
EDGES = [(1, None), (2, ""), (3, "   \n\t "), (None, "The and of it is here."), (4, "x" * 200_000), (5, "The same text for two."), (6, "The same text for two."),
         (7, "Repeated row."), (7, "Repeated row."), (8, "né 😀 ünï\u0000code ﻿"), (9, "12345 678"), (10, "word " * 30_000)]
