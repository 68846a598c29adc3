"""The two similarity measures of names, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelgap.functions.clean import normalize_name


def trigrams(c: Column) -> Column:
    """Distinct three-grams of each word, padded with two spaces before and one after, in lower case."""
    words = F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substr(p, i, F.lit(3))))))


def trigram_overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two trigram sets; zero where both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both.cast("double"), F.size(a) + F.size(b) - both), F.lit(0.0))


def trigram_similarity(a: Column, b: Column) -> Column:
    return trigram_overlap(trigrams(a), trigrams(b))


def length_ratio(a: Column, b: Column) -> Column:
    return F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def edit_similarity(a: Column, b: Column, guard: float, threshold: float = 0.0) -> Column:
    """1 - edit distance / longer length of normalised names; zero below the length ratio ``guard``, one for equals.

    The cheap tests stand before the distance, which is computed only where they leave it open; with a ``threshold``,
    similarities below it may come out as anything smaller.
    """
    longer = F.greatest(F.length(a), F.length(b))
    distance = F.levenshtein(a, b)
    if threshold:
        most = F.floor(longer * (1 - threshold) + 1e-9).cast("int")
        distance = F.pmod(F.call_function("levenshtein", a, b, most), F.lit(1 << 30))  # -1, for more than ``most``, as something large
    return F.when(a == b, 1.0).when(length_ratio(a, b) < guard, 0.0).otherwise(1.0 - distance / longer)


def title_similarity(a: Column, b: Column, guard: float = 0.3) -> Column:
    return edit_similarity(normalize_name(a), normalize_name(b), guard)
