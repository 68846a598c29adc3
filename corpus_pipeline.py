"""From raw documents to packed training windows: quality rules, line dedup, MinHash near-dedup, suffix dedup, packing.

``documents`` (doc_id, text, lang, source, n_chars) go in. Each stage takes what the one before it kept, as read back
from Parquet, and all but the last give the same columns: text that a stage cuts is counted anew in n_chars, and a
document left without words goes. The last gives packing's pieces. Each stage states in its operator how it treats
nulls, empty texts, ties and repeated rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reelgap.llm import line_dedup, near_dup, packing, quality_rules, suffix_dedup
from reelgap.llm.scratch import Scratch, release_shuffles, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose n-grams are likely enough in trusted text."""
    return quality_rules.keep_good(docs, quality_rules.log_ratios(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines of 50 words and more stay where they come first, and go whole elsewhere."""
    return line_dedup.keep_first_runs(docs, min_words=50)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, similarity of 0.8 or more."""
    return near_dup.keep_one(docs, width=5, percent=80)


def suffixes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte strings that come twice go."""
    return suffix_dedup.keep_unrepeated(docs, length=200)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), window=4096, end_id=2)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("minhash_near_dedup", near), ("suffix_array_dedup", suffixes), ("packing", windows)]

#: SQL can't state near-duplicates by sampled branches, tokens or packing; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents in ``sf_dir``."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        release_shuffles(spark)
    return last(spark, docs, sf_dir)
