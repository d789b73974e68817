"""Documents to training sequences: quality rules, near-duplicates, repeated strings, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs. All but the last return the columns of `documents`, with
n_chars counted again where the text changed. Every stage works on all rows it is given, whatever
their number, and reads its settings from the operators' defaults; near duplicates are linked from
a similarity of `near_duplicates.CORPUS_PERCENT` on.

Cases: the first stage rejects null and empty texts, the others keep what they are given (a null
text stays null). Null ids pass all stages; repeated rows are one row from the second stage on. Very
long texts are worked on whole. Columns other than those of `documents` are dropped, and an empty
table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import near_duplicates, packing, quality, substrings
from reelhouse.llm.components import stored
from reelhouse.llm.rows import table
from reelhouse.session import scratch_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that fail them."""
    return quality.cleaned_documents(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Of rows that share its id and text, the one stays whose language, source and length come first
    (nulls before all), whatever the order of the rows. Rows with a null id are linked with nothing,
    and of those with one text one stays.
    """
    groups = near_duplicates.near_duplicates(docs, percent=near_duplicates.CORPUS_PERCENT)
    kept = groups.filter("kept").select("doc_id", "text_hash").distinct()
    docs = docs.select(*COLUMNS).withColumn("text_hash", F.xxhash64("text"))
    same = docs["doc_id"].eqNullSafe(kept["doc_id"]) & (docs["text_hash"] == kept["text_hash"])
    stay = docs.join(kept, same, "left_semi")
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    one = stay.groupBy("doc_id", "text_hash").agg(
        F.min(F.struct(*rest)).alias("rest"), F.first("text").alias("text")
    )
    return one.select("doc_id", "text", "rest.*").select(*COLUMNS)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the strings of 100 bytes that start earlier as well."""
    left = substrings.remove_repeats(docs.select(*COLUMNS))
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeated_strings),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is a table in the shared folder."""
    docs, folder = table(spark, sf_dir, "documents"), scratch_dir(spark)
    for i, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{i}-{name}")
    return docs


#: Connected components, suffix arrays and packing have no SQL; the stages are tested against
#: brute force in tests/llm.
ORACLE_SQL = None
