"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import (
    class_lm,
    conversations,
    counts,
    extract,
    near_duplicates,
    nearest,
    packing,
    prefix_bpe,
    quality,
    repair,
    resampling,
    simhash,
    substrings,
)
from reelhouse.llm.rows import table
from reelhouse.session import scratch_dir


def op1_hyperminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near duplicates of every document, linked from a similarity of 85 % on."""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), percent=85).drop("text_hash")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated strings of 100 bytes."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), with_text=False, carry=False)


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the line-first verdict of every document."""
    return quality.digest(table(spark, sf_dir, "documents"))


def op4_rabitq_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids to compressed files, and digest what the files hold."""
    folder = f"{scratch_dir(spark)}/tokens"
    path = public_tokenizers.path("byte_bpe_50k.json")
    repair.write_token_files(table(spark, sf_dir, "documents"), path, folder, end_id=2)
    return repair.read_digests(spark, folder)


def op6_brown_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-model and base scores of every document, learned from nine in ten of them."""
    return class_lm.text_scores(table(spark, sf_dir, "documents"), every_word=True)


def op7_crf_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract.extract_text(table(spark, sf_dir, "pages"))


def op8_conflict_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 8192 bytes from all documents; no two of a source or near copies in one."""
    return packing.pack(table(spark, sf_dir, "documents"), percent=near_duplicates.CORPUS_PERCENT)


def op9_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    return prefix_bpe.encode_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op10_resync_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and the group that it is linked with."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and place of every document in a draw towards the benchmark's words."""
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and the cheapest edits that repair it."""
    return conversations.repair_digests(conversations.damaged(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hyperminhash_dedup": op1_hyperminhash_dedup,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_line_quality": op3_line_quality,
    "op4_rabitq_search": op4_rabitq_search,
    "op5_repair_tokens": op5_repair_tokens,
    "op6_brown_scores": op6_brown_scores,
    "op7_crf_extract": op7_crf_extract,
    "op8_conflict_packing": op8_conflict_packing,
    "op9_prefix_bpe": op9_prefix_bpe,
    "op10_resync_counts": op10_resync_counts,
    "op11_simhash_dedup": op11_simhash_dedup,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES: dict[str, str] = {
    "op3_line_quality": quality.SQL,
    "op4_rabitq_search": nearest.SQL,
    "op12_importance_resampling": resampling.SQL,
}
