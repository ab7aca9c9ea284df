"""From raw documents to token ids: five stages, each written as Parquet and read by the next.

1. Documents without a letter go. Letters that are like no language learned stay, as no
   least score was measured that keeps all clean documents.
2. Of documents linked by a similarity of 0.8 over five-word shingles one stays.
3. Passages of 200 bytes and more that occur again are cut out of the texts.
4. Documents that contain a benchmark item, or one with other numbers or names, go.
5. What is left is encoded; ids and the decoded text are checked by digests.

A stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns the columns
of ``documents``; the last returns ids. NULL texts go in stage 1, and so do empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truegrain.llm import bpe, common, jaccard, language, repeats, templates
from truegrain.llm.catalog import TOKENIZER
from truegrain.session import new_shared_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identified(docs, language.learn(docs))


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.kept_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return templates.clean_documents(docs, common.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(docs, TOKENIZER)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_similar),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: No SQL: language vectors, components and BPE are iterative.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = new_shared_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
