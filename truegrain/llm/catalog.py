"""The operators as queries on the supplied tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truegrain.llm import (
    bpe,
    common,
    html_text,
    jaccard,
    language,
    lengths,
    maglev,
    orchard,
    packing,
    planes,
    repeats,
    sketch,
    templates,
    turns,
)
from truegrain.llm.oracle import ORACLE  # noqa: F401
from truegrain.session import new_shared_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op7_bpe_segment_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole text encoded and decoded: number of ids and two digests."""
    return bpe.digests(bpe.encode(common.table(spark, folder, "documents"), TOKENIZER))


def op1_bit_planes(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole text encoded, written as byte planes and read back."""
    path = new_shared_path(spark, "planes")
    planes.write(common.table(spark, folder, "documents"), path, TOKENIZER)
    return planes.read(spark, path, with_ids=False)


def op2_threshold_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return sketch.fingerprints(common.table(spark, folder, "documents"))


def op3_composite_text_density(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    pages = common.table(spark, folder, "pages")
    return html_text.extract(pages, {"page_id": F.col("page_id"), "url": F.col("url")})


def op4_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and benchmark item that contaminates it."""
    documents, benchmark = (common.table(spark, folder, t) for t in ("documents", "benchmark"))
    return templates.contaminated(documents, benchmark, forms=templates.ALL_FORMS).select(
        F.col("id").alias("doc_id"),
        F.col("item").alias("item_id"),
        *(F.col(c).cast("bigint").alias(c) for c in ("n_words", "n_covered", "n_slots", "n_changed")),
    )


def op5_hyperdimensional_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    documents = common.table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language.learn(documents.where(~held_out))
    return language.predict(documents, model, {"doc_id": F.col("doc_id"), "held_out": held_out})


def op6_maglev_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document among 64."""
    documents = common.table(spark, folder, "documents").select("doc_id")
    return maglev.place(documents, [f"shard-{i:03d}" for i in range(64)])


def op8_length_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by encoded length, with the sums for every context limit."""
    return lengths.histogram(lengths.encoded_lengths(common.table(spark, folder, "documents"), TOKENIZER))


def op9_deep_shallow_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that occur again."""
    return repeats.digests(repeats.removed(common.table(spark, folder, "documents")))


def op10_prefix_tree_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents with a Jaccard similarity of 0.9 over three-word shingles."""
    return jaccard.linked_components(common.table(spark, folder, "documents"))


def op11_dominance_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids packed into sequences of at most 2,048."""
    return packing.packed(common.table(spark, folder, "documents"), TOKENIZER)


def op12_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, damaged and repaired by the cheapest edits."""
    conversations = turns.damaged(common.table(spark, folder, "conversations"))
    return turns.summaries(turns.repair(conversations, count_col="n"))


def op13_orchard_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all embeddings under codebooks refined over six rounds."""
    return orchard.digests(common.table(spark, folder, "embeddings"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bit_planes": op1_bit_planes,
    "op2_threshold_sketch": op2_threshold_sketch,
    "op3_composite_text_density": op3_composite_text_density,
    "op4_template_decontamination": op4_template_decontamination,
    "op5_hyperdimensional_language": op5_hyperdimensional_language,
    "op6_maglev_sharding": op6_maglev_sharding,
    "op7_bpe_segment_tree": op7_bpe_segment_tree,
    "op8_length_histogram": op8_length_histogram,
    "op9_deep_shallow_repeats": op9_deep_shallow_repeats,
    "op10_prefix_tree_join": op10_prefix_tree_join,
    "op11_dominance_packing": op11_dominance_packing,
    "op12_turn_repair": op12_turn_repair,
    "op13_orchard_codes": op13_orchard_codes,
    "pipeline": pipeline,
}
