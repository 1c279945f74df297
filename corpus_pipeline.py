"""Corpus pipeline: quality classifier, line dedup, near-duplicates, mixing, tokens."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exportlens.llm import bpe, classifier, lines, minhash, mixing
from exportlens.llm.common import CACHED_WORDS, checkpoint_folder, cut
from exportlens.llm.queries import LEAST_SCORE, VOCABULARY


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels of this folder, scores 0.3 or more.

    Null and empty texts are scored as such; equal rows share their fate; no rows give none. Only the columns of documents are
    taken, here and in every stage, so others of any name don't matter.
    """
    docs = docs.select(COLUMNS)
    model = classifier.train(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    return classifier.with_score(docs, model, least=LEAST_SCORE).select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages, n_chars as they are now; documents of which nothing is left go.

    Null and empty texts and texts without repeats stay as they are; equal rows share their fate; no rows give none.
    """
    cleaned = lines.dedup_lines(docs.select(COLUMNS))
    cleaned = cleaned.where("n_removed_lines = 0 OR clean_text RLIKE '[^ \\\\t\\\\n\\\\x0B\\\\f\\\\r]'")
    return cleaned.withColumn("text", F.col("clean_text")).withColumn("n_chars", F.when(
        F.col("n_removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id; documents without id stay.

    Null and empty texts have no near-duplicates. Rows that share an id share its fate; no rows give none.
    """
    docs = docs.select(COLUMNS)
    found = minhash.near_duplicates(docs)
    gone = cut(found.where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct())
    if gone.count() <= minhash.FEW_IDS:  # the documents then stay where they are
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(COLUMNS)


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics have their target weights.

    Documents without words stay; rows that share an id share the draw; nulls are values of their own; no rows give none.
    """
    return mixing.mix(docs.select(COLUMNS)).where("mix_sampled").select(COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left; null texts count as empty, equal rows come out equal.

    Workers keep fewer pre-tokens than on their own: the executor's heap has grown in the stages before.
    """
    slim = docs.select("doc_id", "source", "lang", "text")
    return bpe.encode_column(slim, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, prefix="", cached=CACHED_WORDS).drop("text")


STAGES = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("source_mixing", sample_mixture),
    ("byte_bpe", tokenize),
]

#: Training, hashing and tokenising can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage's rows are written below the checkpoint folder and read again."""
    folder = f"{checkpoint_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select(COLUMNS)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
