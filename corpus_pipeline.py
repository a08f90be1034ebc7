"""Corpus pipeline: language ID, exact dedup, near-dedup, mixing, token ids.

Each stage works on all rows that its predecessor kept. All but the last return the
columns of ``documents``; between stages the rows are written as Parquet below the
folder that the cluster shares and read again, so a lost executor costs a stage at
most. Two stages have no SQL (compression, learned posteriors); the whole is tested
against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from settlekit.llm import bpe, digest_index, langid, minmax, mixing
from settlekit.llm.common import table, written
from settlekit.llm.queries import BYTE_BPE

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language is narrow or unknown go; ``lang`` becomes the language found."""
    return langid.keep_identified(docs, langid.train(langid.training_rows(docs)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays, that with the largest doc_id."""
    return digest_index.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return minmax.keep_representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay by their rate, at most 1: good ones set the total, of which poor and toxic ones are at most their shares."""
    return mixing.keep_mixed(docs, mixing.label_domains(table(spark, sf_dir, "labels")), most=1.0, keep="good")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, and digests of the ids and of the text that they decode to."""
    return bpe.round_trip(docs, BYTE_BPE, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("token_ids", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
