"""The dealt operators as queries over the test tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exportlens.llm import bpe, classifier, conversations, embeddings, licenses, lines, minhash, mixing, pieces, quality, search, secrets, warc
from exportlens.llm.oracles import ORACLES  # noqa: F401

VOCABULARY = "byte_bpe_50k.tiktoken"
PIECE_MODEL = "piece_bpe_32k.model"
LEAST_SCORE = 0.3


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode_column(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, prefix="").drop("text")


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"), words=4)


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, folder, "documents"))
    number = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    both = F.array_sort(F.concat("base", "random"))
    return found.select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
                        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"), secrets.span_text(both).alias("spans"))


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_matches(_table(spark, folder, "documents")).withColumn("line", F.col("line").cast("long"))


def embedding_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.linked_vectors(_table(spark, folder, "embeddings"))


def warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_roundtrip(_table(spark, folder, "pages"))


def adaptive_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(_table(spark, folder, "documents"))


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = lines.dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed_chunks", "n_removed_lines", F.sha2("clean_text", 256).alias("clean_sha256"))


def source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    return mixing.mix(docs, keep_text=False)


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    scored = classifier.with_score(docs, classifier.train(docs, _table(spark, folder, "labels")))
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"), "score",
                         (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.ranked_documents(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def piece_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return pieces.encode_column(docs, public_tokenizers.path(PIECE_MODEL), prefix="").drop("text")


def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(conversations.damage(_table(spark, folder, "conversations")), "copies")


QUERIES = {
    "op1_byte_bpe": byte_bpe,
    "op2_minhash_near_dedup": near_duplicates,
    "op3_secret_scan": secret_scan,
    "op4_license_scan": license_scan,
    "op5_embedding_near_dedup": embedding_near_duplicates,
    "op6_warc_archive": warc_archive,
    "op7_adaptive_quality": adaptive_quality,
    "op8_line_dedup": line_dedup,
    "op9_source_mixing": source_mixing,
    "op10_quality_classifier": quality_classifier,
    "op11_ranked_search": ranked_search,
    "op12_piece_bpe": piece_bpe,
    "op13_conversation_repair": conversation_repair,
}
