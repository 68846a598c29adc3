"""The subpackage's registered queries, with production parameters, and SQL for those that SQL can state."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgap.llm import bytepairs, line_dedup, near_dup, packing, quality_classifier, quality_rules, suffix_dedup, topk, urls, warc
from reelgap.llm.scratch import Scratch, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


@_query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), window=4096, end_id=2)


@_query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bytepairs.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bytepairs.digest(bytepairs.decode(ids, path))


def warc_digest(captures: DataFrame) -> DataFrame:
    r = F.col("response")
    return warc.with_referred_pages(captures).select(F.col("metadata.page_id").alias("page_id"), r["payload_bytes"].alias("payload_bytes"), r["payload_digest"].alias("payload_digest"), r["kind"].alias("record_type"), F.col("refers_to_page").alias("refers_to"))


@_query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), scratch.path("archive"), min_bytes=0)
    captures = scratch.keep(warc.captures(warc.read(spark, scratch.path("archive"))), "captures")
    scratch.drop("archive")
    return warc_digest(captures)


#: The same rows as op8_warc, as DuckDB reads it; base32 takes five bits of the SHA-1 at a time.
ORACLE["op8_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, unhex(sha1(html))::BIT::VARCHAR AS bits FROM p),
d AS (
  SELECT page_id, payload_bytes,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + substr(bits, 5 * i::INTEGER + 1, 5)::BIT::INTEGER, 1) FOR i IN range(32)], '') AS payload_digest
  FROM h
),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


@_query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.measures(docs, quality_rules.log_ratios(docs, table(spark, sf_dir, "labels")))


@_query
def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


ORACLE["op10_exact_top_k"] = topk.SQL


@_query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.classify(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


#: (verdict, host and path) of the rules; the longest that fits decides.
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("block", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


@_query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@_query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op9_line_dedup"] = line_dedup.SQL


@_query
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.group(table(spark, sf_dir, "documents"), width=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


@_query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"), length=200)
