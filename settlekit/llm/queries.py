"""The operators' registered queries, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, credentials, digest_index, extract, knn, langid, merkle, minmax, mixing, quality, variants, warc
from .common import crc_bucket, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op2_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op3_warc_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_index.exact_dedup(table(spark, sf_dir, "documents")).drop("copies")


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), mixing.label_domains(table(spark, sf_dir, "labels")))


#: The contract's shingles and similarity.
OP6 = minmax.MinMax(words=3, percent=85, rows=6, bands=32)


def op6_min_max_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), OP6).drop("copies")


def op7_compression_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(langid.training_rows(docs)))
    return found.select("doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op8_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


def op9_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.scan(table(spark, sf_dir, "documents"))


def op10_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = table(spark, sf_dir, "embeddings")
    return knn.voronoi_top_k(data.filter(F.col("vec_id") % 50 == 0), data)


def op11_path_copying_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


def op12_kd_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def op13_offset_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.format_conversations(chat.with_tricky(table(spark, sf_dir, "conversations")), BYTE_BPE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nbsvm_quality": op1_nbsvm_quality,
    "op2_wrapper_extraction": op2_wrapper_extraction,
    "op3_warc_splits": op3_warc_splits,
    "op4_digest_index": op4_digest_index,
    "op5_soft_mixing": op5_soft_mixing,
    "op6_min_max_hashing": op6_min_max_hashing,
    "op7_compression_langid": op7_compression_langid,
    "op8_pair_index_bpe": op8_pair_index_bpe,
    "op9_credential_linking": op9_credential_linking,
    "op10_voronoi_top_k": op10_voronoi_top_k,
    "op11_path_copying_manifest": op11_path_copying_manifest,
    "op12_kd_variants": op12_kd_variants,
    "op13_offset_masks": op13_offset_masks,
}

ORACLE: dict[str, str] = {
    "op3_warc_splits": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
        b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
                ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111']
                [strpos('0123456789abcdef', substr(h, i, 1))]), '') AS bits,
              min(page_id) OVER (PARTITION BY body) AS first FROM p)
        SELECT page_id, octet_length(encode(body)) AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
                 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
                 + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM b
    """,
    "op4_digest_index": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_min_max_hashing": minmax.oracle(OP6),
    "op9_credential_linking": credentials.oracle(),
    "op10_voronoi_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.e, d.e)::BIGINT AS score
          FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        WHERE rank <= 5
    """,
    "op11_path_copying_manifest": merkle.oracle(),
    "op12_kd_variants": variants.oracle(),
    "op13_offset_masks": chat.oracle(),
}
