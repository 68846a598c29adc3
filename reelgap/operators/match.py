"""Matching of names: blocked joins, then the best candidate of each row.

Each join has an equality to shuffle on (date or year); similarity is a condition on what meets. Ties go to the
smallest name, where the source system takes whatever comes first.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgap.functions import similarity as sim
from reelgap.functions.clean import normalize_name, strip
from reelgap.operators import nearest


def top_one(rows: DataFrame, by: list[str], *order: Column) -> DataFrame:
    """The first row of each group; Spark keeps only the first rows of each partition before it shuffles."""
    return rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_nth = 1").drop("_nth")


def first_spellings(rows: DataFrame, name: str, date: str, order: str) -> DataFrame:
    """One row per lower-cased name and date, with the spelling that came first."""
    kept = rows.where(F.col(name).isNotNull() & F.col(date).isNotNull())
    return kept.groupBy(F.lower(name).alias("name_key"), F.col(date).alias(date)).agg(F.min_by(name, order).alias(name))


def exact_matches(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """(movie_name, release_date, canonical): stored spellings that differ in case or outer space only."""
    s = stored.select(F.col("movie_name").alias("canonical"), "release_date").distinct()
    key = F.lower(strip(F.col("movie_name")))
    i = incoming.select("movie_name", "release_date", key.alias("_k"))
    s = s.withColumn("_k", F.lower(strip(F.col("canonical"))))
    rows = i.join(s, ["release_date", "_k"]).where(strip(F.col("movie_name")) != strip(F.col("canonical")))
    return rows.groupBy("movie_name", "release_date").agg(F.min("canonical").alias("canonical"))


def _openers(side: DataFrame, name: str, counts: DataFrame, least: float) -> DataFrame:
    """A row of ``side`` for each gram that a set at least ``least`` alike must share one of, rarest first."""
    grams = side.select(name, "release_date", F.explode(f"_{name}").alias("_gram")).join(counts, "_gram", "left")
    order = F.sort_array(F.collect_list(F.struct(F.coalesce("_count", F.lit(0)).alias("n"), F.col("_gram").alias("g"))))
    n = F.size("_all")
    named = grams.groupBy(name, "release_date").agg(order.alias("_all"))
    named = named.withColumn(f"_{name}", F.col("_all")["g"])
    return named.select(name, "release_date", f"_{name}", F.explode(F.slice(F.col("_all")["g"], 1, (n - F.ceil(n * least - 1e-9) + 1).cast("int"))).alias("_gram"))


def trigram_matches(incoming: DataFrame, stored: DataFrame, warn: float = 0.75, auto: float = 0.93, ratio: float = 0.70) -> DataFrame:
    """(movie_name, release_date, canonical, similarity, tier) of the most similar stored name of the same date.

    The filter takes the similarity as it is, the tier takes it rounded to three places. Trigrams are made once per
    name, before the join. Two sets that are ``warn`` alike share one of the first grams of both in any one order, so
    names meet on a date and such a gram; grams stand in order of rarity, and ``warn`` has to be above zero.
    """
    side = lambda df, name: df.select(F.col("movie_name").alias(name), "release_date", sim.trigrams(F.col("movie_name")).alias(f"_{name}")).distinct()
    coming, known = side(incoming, "movie_name"), side(stored, "canonical")
    counts = known.select(F.explode("_canonical").alias("_gram")).groupBy("_gram").agg(F.count(F.lit(1)).alias("_count"))
    rows = _openers(coming, "movie_name", counts, warn).join(_openers(known, "canonical", counts, warn), ["release_date", "_gram"])
    a, b, m, n = strip(F.col("movie_name")), strip(F.col("canonical")), F.size("_movie_name"), F.size("_canonical")
    rows = rows.where((F.least(m, n) >= F.greatest(m, n) * warn - 1e-9) & (sim.length_ratio(a, b) >= ratio) & (F.lower(a) != F.lower(b)))
    rows = rows.withColumn("similarity", sim.trigram_overlap(F.col("_movie_name"), F.col("_canonical"))).where(F.col("similarity") >= warn)
    best = top_one(rows, ["movie_name", "release_date"], F.desc("similarity"), F.asc("canonical"))
    return best.select("movie_name", "release_date", "canonical", "similarity", F.when(F.round("similarity", 3) >= auto, "merge").otherwise("warn").alias("tier"))


def canonical_names(incoming: DataFrame, stored: DataFrame, order: str, warn: float = 0.75, auto: float = 0.93, max_pairs: int | None = None) -> DataFrame:
    """(name_key, release_date, canonical): what to call incoming films; a close match goes before an exact one.

    ``max_pairs`` skips the step for larger batches, as the source system does; there is no limit by default.
    """
    pairs = first_spellings(incoming, "movie_name", "release_date", order).select("movie_name", "release_date")
    if max_pairs is not None and pairs.limit(max_pairs + 1).count() > max_pairs:
        pairs = pairs.where(F.lit(False))
    close = trigram_matches(pairs, stored, warn, auto).where("tier = 'merge'").select("movie_name", "release_date", F.col("canonical").alias("close"))
    exact = exact_matches(pairs, stored)
    rows = exact.join(close, ["movie_name", "release_date"], "full_outer")
    return rows.select(F.lower(strip(F.col("movie_name"))).alias("name_key"), strip(F.col("release_date")).alias("_date"), F.coalesce("close", "canonical").alias("canonical")).groupBy("name_key", "_date").agg(F.min("canonical").alias("canonical")).withColumnRenamed("_date", "release_date")


def rename_canonical(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``rows`` with movie_name replaced by its canonical spelling, and whether it was (``merged``)."""
    keyed = rows.withColumn("_k", F.lower(strip(F.col("movie_name")))).withColumn("_d", strip(F.col("release_date")))
    n = names.select(F.col("name_key").alias("_k"), F.col("release_date").alias("_d"), "canonical")
    joined = keyed.join(n, ["_k", "_d"], "left")
    return joined.withColumn("merged", F.col("canonical").isNotNull()).withColumn("movie_name", F.coalesce("canonical", "movie_name")).drop("_k", "_d", "canonical")


#: Left and right names that one task compares at once, about; and left names of which a share is made while there are tasks for it.
LEFT, RIGHT, SMALL = 1 << 14, 1 << 16, 1 << 10
#: So few pairs, times the longer length, cost less to score one by one than to find the nearest of.
FEW = 1 << 8


def _by_length(names: list[str]) -> dict[int, tuple[np.ndarray, Callable[[], nearest.Trie]]]:
    """For each length the places of its names, in order of the names, and what makes their trie, once."""
    lengths, found = np.array([len(x) for x in names]), {}
    for n in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == n)
        made = np.array([names[i].encode() for i in places], f"S{n}")
        order = np.argsort(made)
        found[n] = places[order], functools.cache(functools.partial(nearest.Trie, made[order], n))
    return found


def _compare(block: list[str], right_name: str, ratio: float, threshold: float, few: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """The nearest right names of each left name, one of each length at least; for shares of the names of one block."""
        chosen = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if len(left) and len(right):
            # places in order of the spellings are ranks; code points order as UTF-8 bytes do
            right = right.take(pc.sort_indices(right[right_name]))
            known = _by_length(right["_b"].to_pylist())
            for m, (a, coming) in _by_length(left["_a"].to_pylist()).items():
                for n, (b, stored) in known.items():
                    if not math.ceil(m * ratio - 1e-9) <= n <= math.floor(m / ratio + 1e-9):
                        continue
                    if len(a) * len(b) <= few * max(m, n):
                        chosen.append((np.repeat(a, len(b)), np.tile(b, len(a))))
                    else:
                        i, j = nearest.nearest(coming(), stored(), b, math.floor(max(m, n) * (1 - threshold) + 1e-9))
                        chosen.append((a[i], b[j]))
        i, j = (pa.array(np.concatenate(x)) for x in zip(*chosen))
        return pa.table({c: left[c].take(i) for c in [*block, "_a"]} | {c: right[c].take(j) for c in ["_b", right_name]})

    return run


def best_by_name(left: DataFrame, right: DataFrame, left_name: str, right_name: str, block: list[str], guard: float, threshold: float, keep: list[str]) -> DataFrame:
    """For each left row the most similar right name of its block, if similar enough.

    Different normalised names meet by block, and only where their lengths allow the threshold: as many edits as the
    lengths differ by are needed at least. Each task gets a share of the left and of the right names, names with a common
    beginning together, and finds the nearest ones in tries (``nearest``); the best over lengths and shares follows.
    """
    a = left.withColumn("_a", normalize_name(F.col(left_name)))
    names = right.withColumn("_b", normalize_name(F.col(right_name))).where("_b is not null").groupBy(*block, "_b").agg(F.min(right_name).alias(right_name))
    distinct = a.where("_a is not null").select(*block, "_a").distinct()
    # a given number of partitions, as few bytes make much work here and Spark would put them into one task
    session = left.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)
    parts = lambda most: F.ceil(F.count(F.lit(1)) / most)
    lefts = distinct.groupBy(*block).agg(F.greatest(parts(LEFT), F.least(parts(SMALL), F.lit(tasks)), F.lit(1)).cast("int").alias("_lefts"))
    rights = names.groupBy(*block).agg(F.greatest(parts(RIGHT), F.lit(1)).cast("int").alias("_rights"))
    meet = lambda x, y: x.join(y, block) if block else x.crossJoin(y)
    sizes = meet(lefts, rights)
    share = lambda c, parts: F.pmod(F.xxhash64(F.substr(c, F.lit(1), F.length(c) - 2)), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    keys = [*block, "_left", "_right"]
    coming = meet(distinct, sizes).select(*block, share(F.col("_a"), "_lefts").alias("_left"), every("_rights").alias("_right"), "_a")
    stored = meet(names, sizes).select(*block, every("_lefts").alias("_left"), share(F.col("_b"), "_rights").alias("_right"), "_b", right_name)
    # new names for the columns, as both sides come from the same tables
    dealt = lambda rows: rows.toDF(*rows.columns).repartition(tasks, *keys).groupBy(*keys)
    schema = T.StructType([*coming.select(*block, "_a").schema, *stored.select("_b", right_name).schema])
    rows = dealt(coming).cogroup(dealt(stored)).applyInArrow(_compare(block, right_name, max(guard, threshold), threshold, FEW), schema)
    # numbered rows keep the filter behind the score, which would otherwise be computed twice
    rows = rows.withColumn("score", sim.edit_similarity(F.col("_a"), F.col("_b"), guard, threshold)).withColumn("_row", F.monotonically_increasing_id())
    rows = rows.where((F.col("score") >= threshold) & (F.col("_row") >= 0)).drop("_row")
    best = top_one(rows, [*block, "_a"], F.desc("score"), F.asc(right_name)).select(*block, "_a", right_name, "score")
    return a.join(best, [*block, "_a"]).select(*keep, right_name, "score")


def compatible_years(a: Column, b: Column) -> Column:
    """Candidates are rejected only where both years are known and differ."""
    return a.isNull() | b.isNull() | (a == b)
