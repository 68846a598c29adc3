"""Quality rules: counts of each text, and an n-gram likelihood ratio between trusted text and the raw corpus.

Everything here is built from DataFrame functions. Words and pairs of words are hashed into a fixed number of
buckets. Two multinomials over the buckets, of the trusted documents and of all documents, give each bucket a log
ratio; a document's score is the mean ratio of its n-grams. A document is kept if it passes the base rules and its
score reaches the threshold.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgap.llm.fences import fenced

#: Fixed: what ends a word, and what counts as a symbol.
WHITE, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
BUCKETS = 1 << 14
#: Raw n-grams that count as trusted, a bucket: 10 give unlabelled text of the same kind the same verdicts at all sizes.
PRIOR = 10
#: Ids of trusted documents that are broadcast at most.
BROADCAST = 2_000_000
#: A document goes if its n-grams are on average this much (in nats) likelier in the raw corpus than in trusted text.
THRESHOLD = -0.08


def without(text: Column, characters: str) -> Column:
    """``text`` less some ASCII characters: a byte search for each is far cheaper than a map of every character."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    for c in WHITE[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.filter(F.split(text, " "), lambda w: w != "")


def buckets(hashes: Column, n: int = BUCKETS) -> Column:
    """Bucket of each word, then of each pair of neighbours."""
    pairs = F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))), lambda h, i: F.xxhash64(h, F.get(hashes, i + 1)))
    return F.transform(F.concat(hashes, pairs), lambda h: F.pmod(h, F.lit(n)).cast("int"))


def hashed(docs: DataFrame) -> DataFrame:
    """_row: the row; _text; _hashes: of its words in order."""
    rows = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    return rows.withColumn("_words", words(F.col("_text"))).select("_row", "_text", F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))


def _joinable(ids: DataFrame) -> DataFrame:
    """``ids`` for a join: broadcast if they are BROADCAST at most (16 bytes each), else joined by shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST else ids


def log_ratios(docs: DataFrame, labels: DataFrame, n: int = BUCKETS, prior: int = PRIOR) -> list[float]:
    """log(trusted / raw) of each bucket; zeros without trusted documents and for buckets that no n-gram falls in.

    All ``docs`` count as raw. Trusted are all that ``labels`` calls good and not toxic, together with ``prior`` n-grams
    a bucket, on average, that are spread like the raw ones: with little trusted text the ratios are near zero.
    """
    ids = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").cast("long").alias("_id")).distinct()
    ids = _joinable(ids).withColumn("_trusted", F.lit(1))
    grams = hashed(docs).select(F.col("_row.doc_id").cast("long").alias("_id"), buckets(F.col("_hashes"), n).alias("_grams"))
    grams = grams.join(ids, "_id", "left").select(F.explode_outer("_grams").alias("_gram"), "_trusted")
    counts = grams.where("_gram is not null").groupBy("_gram").agg(F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("trusted")).collect()  # n rows at most
    raw, good = sum(r.raw for r in counts), sum(r.trusted for r in counts)
    out = [0.0] * n
    for r in counts:
        out[r["_gram"]] = math.log((r.trusted * raw / r.raw + prior * n) / (good + prior * n))
    return out


def measured(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """_row, and the measures and verdict beside it."""
    n, h = F.size("_hashes"), F.col("_hashes")
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = hashed(docs).select(
        "_row", "_hashes",
        n.cast("long").alias("_n_words"),
        F.length(without(F.col("_text"), WHITE)).cast("long").alias("_word_chars"),
        (F.octet_length("_text") - F.octet_length(without(F.col("_text"), SYMBOLS))).cast("long").alias("_n_symbols"),
        lines.alias("_lines"),
        F.transform(F.slice(h, 1, F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))).alias("_windows"),
        buckets(h, len(ratios)).alias("_grams"),
    )
    weights = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    rows = rows.select(
        "_row", "_n_words", "_word_chars", "_n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("_n_dup_lines"),
        # only texts with a repeated window are sorted
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.array_sort(F.transform("_windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("_sorted"),
        F.coalesce(F.try_divide(F.aggregate("_grams", F.lit(0.0), lambda a, g: a + F.get(weights, g)), F.size("_grams")), F.lit(0.0)).alias("_score"),
    )
    s = F.col("_sorted")
    rows = rows.withColumn("_at", F.sort_array(F.transform(F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))
    covered = F.aggregate("_at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")), lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")))["n"]
    return rows.withColumn("_n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))


def judged(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD) -> DataFrame:
    failed = (F.col("_n_words") < 50) | (100 * F.col("_n_repeat_words") > 50 * F.col("_n_words"))
    return measured(docs, ratios).withColumn("_failed", failed).withColumn("_kept", ~failed & (F.col("_score") >= threshold))


def measures(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """A row of counts and verdict for each row of ``docs`` (doc_id, text).

    A null or empty text has no words and fails; a text of any length is counted whole; a null doc_id stays null;
    repeated rows are measured each; other columns are not read; an empty table gives no rows.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged(docs, ratios, threshold).select(F.col("_row.doc_id").cast("long").alias("doc_id"), *[F.col(f"_{x}").alias(x) for x in names], F.col("_failed").alias("base_failed"), F.col("_kept").alias("kept"), F.col("_score").alias("score"))


def keep_good(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that are kept."""
    return fenced(judged(docs, ratios, threshold), F.col("_kept")).select("_row.*")
