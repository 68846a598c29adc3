"""Removal of repeated runs of lines, by distributed prefix doubling over line-ID sequences.

A document is the sequence of the IDs (128 bits) of its lines that have words; a suffix is named by document and line,
and has a place in the order of (doc_id, document, line). Prefix doubling gives every suffix a rank for its first 1, 2,
4, ... lines: suffixes that agree in the ranks of both halves are one interval of the suffix array, with a common
prefix at least that long, and their rank is the first place in the interval, so ranks are equal exactly if the lines
are. Intervals of one are left behind after each doubling. Two overlapping ranks give the interval at any depth
between two powers of two.

A run of lines counts once it has ``min_words`` words. Its interval at the depth of the shortest such run from a line
on, and of the shortest one up to a line, tells whether it repeats and where it comes first: a maximal repeated run is
the union of those inside it (and of pairs of lines, for what stands between two lines with enough words each), so
removing all but the first copy of each removes later copies of maximal runs whole.

Everything here is built from DataFrame functions. A line that holds many of the rows is joined by broadcast, all
others by shuffle, and counted by partial aggregates, so no task gets the rows of a frequent line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgap.llm import hotkeys
from reelgap.llm.fences import fenced
from reelgap.llm.scratch import Scratch, release_shuffles

#: Fewest words of a run that is removed.
MIN_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"


def _keyed(docs: DataFrame) -> DataFrame:
    """_row: the row; _key: 128 bits of doc_id and text, as rows that repeat both are one document; _id; _text."""
    text, doc_id = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("doc_id").cast("long")
    key = F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), text)))
    return docs.select(F.struct("*").alias("_row"), key.alias("_key"), doc_id.alias("_id"), text.alias("_text"))


def _lines(keyed: DataFrame) -> DataFrame:
    """A row for each line with words: its place among such lines (idx) and among all (pos), its ID (h, h2), its words."""
    lines = F.transform(F.split("_text", "\n"), lambda x, i: F.struct(i.alias("pos"), F.xxhash64(x).alias("h"), F.xxhash64(F.lit(1), x).alias("h2"), F.regexp_count(x, F.lit(WORD)).alias("words")))
    return keyed.select("_key", "_id", F.filter(lines, lambda x: x["words"] > 0).alias("_lines")).select("_key", "_id", F.posexplode_outer("_lines").alias("idx", "line")).where("idx is not null").select("_key", "_id", "idx", "line.*")


def _reach(a: Column, i: Column, min_words: int) -> Column:
    """How many lines from place ``i`` of ``a`` have ``min_words`` words together; null if the lines don't follow each other so far."""
    zero = F.struct(F.lit(0).alias("lines"), F.lit(0).alias("words"))
    more = lambda s, x: F.when((s["words"] < min_words) & (x["idx"] == F.get(a, i)["idx"] + s["lines"]), F.struct((s["lines"] + 1).alias("lines"), (s["words"] + x["words"]).alias("words"))).otherwise(s)
    got = F.aggregate(F.slice(a, i + 1, F.lit(min_words)), zero, more)
    return F.when(got["words"] >= min_words, got["lines"])


def _reach_back(a: Column, i: Column, min_words: int) -> Column:
    """How many lines up to place ``i`` of ``a`` have ``min_words`` words together; null if the lines don't follow each other so far."""
    zero = F.struct(F.lit(0).alias("lines"), F.lit(0).alias("words"))
    more = lambda s, x: F.when((s["words"] < min_words) & (x["idx"] == F.get(a, i)["idx"] - s["lines"]), F.struct((s["lines"] + 1).alias("lines"), (s["words"] + x["words"]).alias("words"))).otherwise(s)
    start = F.greatest(i + 2 - min_words, F.lit(1))
    got = F.aggregate(F.reverse(F.slice(a, start, i + 2 - start)), zero, more)
    return F.when(got["words"] >= min_words, got["lines"])


def _suffixes(keyed: DataFrame, min_words: int, scratch: Scratch) -> DataFrame:
    """(p, d, place, idx, h, h2, runs, _key) of each suffix whose first line comes again, and the runs to look up.

    ``p`` follows the order of (doc_id, null first, document, line). ``d`` is that of the document's first suffix, which
    alone has the _key; ``place`` counts from there. ``runs`` are (lines, first and last line) of runs from this suffix
    on: the shortest with enough words, and those that are the shortest up to their last line.
    """
    lines = _lines(keyed)
    again = lines.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = scratch.keep(again, "again")
    total = again.agg(F.sum("n")).first()[0] or 0
    active = hotkeys.joined(lines, again, ["h"], total).drop("n")
    rows = active.groupBy("_id", "_key").agg(F.array_sort(F.collect_set(F.struct("idx", "pos", "h", "h2", "words"))).alias("a"))
    a = F.col("a")
    rows = rows.withColumn("reach", F.transform(a, lambda x, i: _reach(a, i, min_words))).withColumn("back", F.transform(a, lambda x, i: _reach_back(a, i, min_words)))
    run = lambda i, m: F.when(m.isNotNull(), F.struct(i.alias("place"), m.alias("m"), F.get(a, i)["pos"].alias("low"), F.get(a, i + m - 1)["pos"].alias("high")))
    # a line with enough words is a run alone; with its neighbour it says whether what stands between them goes too
    both = lambda x, i: (F.get(a, i + 1)["idx"] == x["idx"] + 1) & (F.greatest(x["words"], F.get(a, i + 1)["words"]) >= min_words)
    twos = F.transform(a, lambda x, i: F.when(both(x, i), run(i, F.lit(2))))
    runs = F.array_distinct(F.concat(F.transform("reach", lambda m, i: run(i, m)), F.transform("back", lambda m, i: run(i - m + 1, m)), twos))
    rows = rows.withColumn("runs", F.filter(runs, lambda r: r.isNotNull())).select("_id", "_key", "a", "runs")
    rows = rows.orderBy("_id", "_key").select("_key", "runs", F.posexplode("a").alias("place", "x"))
    rows = rows.withColumn("p", F.monotonically_increasing_id())
    first = F.col("place") == 0
    return scratch.keep(rows.select("p", (F.col("p") - F.col("place")).alias("d"), "place", "x.idx", "x.h", "x.h2", F.when(first, F.col("_key")).alias("_key"), F.when(first, F.col("runs")).alias("runs")), "suffixes")


def _ranks(suffixes: DataFrame, levels: int, scratch: Scratch) -> list[DataFrame]:
    """(p, d, idx, rank) of the suffixes whose first 1, 2, 4, ... lines come again, a table for each doubling."""
    total = suffixes.count()
    first = suffixes.groupBy("h", "h2").agg(F.min("p").alias("rank"), F.count(F.lit(1)).alias("n")).where("n > 1")
    out = [scratch.keep(hotkeys.joined(suffixes.select("p", "d", "idx", "h", "h2"), first, ["h", "h2"], total).select("p", "d", "idx", "rank"), "rank0")]
    for level in range(levels):
        if not (total := out[-1].count()):
            return out[:-1]
        ahead = Window.partitionBy("d").orderBy("idx").rangeBetween(1 << level, 1 << level)
        pairs = out[-1].withColumnRenamed("rank", "front").withColumn("rear", F.max("front").over(ahead)).where("rear is not null")
        first = pairs.groupBy("front", "rear").agg(F.min("p").alias("rank"), F.count(F.lit(1)).alias("n")).where("n > 1")
        out.append(scratch.keep(hotkeys.joined(pairs, first, ["front", "rear"], total).select("p", "d", "idx", "rank"), f"rank{level + 1}"))
        release_shuffles(scratch.spark)
    return out


def repeated_runs(keyed: DataFrame, scratch: Scratch, min_words: int = MIN_WORDS) -> DataFrame:
    """(_key, _gone): the lines of each document that are in a later copy of a repeated run.

    The first copy is that of the smallest (doc_id, document, line), a null doc_id before all others.
    """
    suffixes = _suffixes(keyed, min_words, scratch)
    levels = _ranks(suffixes, max(min_words, 2).bit_length() - 1, scratch)
    ranks = levels[0].withColumn("level", F.lit(0)) if levels else suffixes.select("p", "d", "idx", F.col("p").alias("rank"), F.lit(0).alias("level")).where(F.lit(False))
    for level, more in enumerate(levels[1:], 1):
        ranks = ranks.unionByName(more.withColumn("level", F.lit(level)))
    # a run of m lines is in the interval of the ranks of its first and of its last 2**level lines
    runs = suffixes.where("place = 0").select("d", F.explode("runs").alias("r")).select("d", (F.col("d") + F.col("r.place")).alias("p"), "r.m", "r.low", "r.high")
    runs = runs.withColumn("level", F.floor(F.log2("m")).cast("int")).withColumn("q", F.expr("p + m - shiftleft(1, level)"))
    ranks = ranks.select("level", "p", "rank")
    runs = runs.join(ranks.withColumnRenamed("rank", "front"), ["level", "p"]).join(ranks.select("level", F.col("p").alias("q"), F.col("rank").alias("rear")), ["level", "q"])
    runs = scratch.keep(runs.select("d", "p", "m", "low", "high", "front", "rear"), "runs")
    intervals = runs.groupBy("m", "front", "rear").agg(F.min("p").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = hotkeys.joined(runs, intervals, ["m", "front", "rear"], runs.count()).where("p <> first")
    gone = later.groupBy("d").agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("low", "high")))).alias("_gone"))
    gone = scratch.keep(suffixes.where("place = 0").select("d", "_key").join(gone, "d").select("_key", "_gone"), "gone")
    scratch.drop("again", "suffixes", "runs", *[f"rank{k}" for k in range(len(levels) + 1)])
    release_shuffles(scratch.spark)
    return gone


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """_row, _lines: of the text, _kept: the places of the lines that stay."""
    keyed = _keyed(docs)
    gone = repeated_runs(keyed, Scratch(docs.sparkSession, "line_dedup"), min_words)
    # the same plan at every size
    rows = keyed.join(gone.hint("merge"), "_key", "left").withColumn("_lines", F.split("_text", "\n"))
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    return rows.select("_row", "_text", "_lines", F.coalesce(F.array_except(every, F.col("_gone")), every).alias("_kept"))


def _text(lines: Column, kept: Column) -> Column:
    return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_lines, n_removed, text (of the lines that stay) for each row of ``docs`` (doc_id, text).

    Lines are what ``\\n`` separates; lines without words are part of no run and go with the runs around them only. A
    null text is one empty line; rows that repeat doc_id and text are one document and give the same result each; a
    null doc_id comes before all others; a text of any length is one row and its lines are never cut; an empty table
    gives no rows; other columns are not read.
    """
    rows = removed_lines(docs, min_words)
    n = F.size("_lines").cast("long")
    return rows.select(F.col("_row.doc_id").cast("long").alias("doc_id"), n.alias("n_lines"), (n - F.size("_kept")).alias("n_removed"), _text(F.col("_lines"), F.col("_kept")).alias("text"))


def keep_first_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated runs removed from ``text`` (and ``n_chars``, if there, counted anew).

    What goes is what ``dedup`` removes. A row that loses all its words goes; all other rows and columns stay.
    """
    rows = removed_lines(docs, min_words).withColumn("_now", F.when(F.size("_kept") < F.size("_lines"), _text(F.col("_lines"), F.col("_kept"))))
    rows = fenced(rows, F.col("_now").isNull() | F.col("_now").rlike(WORD))
    changed = {"text": F.coalesce("_now", "_row.text"), "n_chars": F.when(F.col("_now").isNull(), F.col("_row")["n_chars"]).otherwise(F.length("_now").cast("long")) if "n_chars" in docs.columns else None}
    return rows.select(*[(changed[c] if c in changed else F.col("_row")[c]).alias(c) for c in docs.columns])


#: The same rows as op9_line_dedup, as DuckDB reads it: equal lines of an earlier and a later place are put into runs
#: by the distance between them; a run of 50 words and more goes in the later place.
SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM d),
b AS (
  SELECT doc_id, pos, line, nw, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS idx
  FROM (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS nw FROM l) WHERE nw > 0
),
e AS (
  SELECT y.doc_id, y.pos, y.nw, y.idx, x.doc_id AS early, y.idx - x.idx AS apart,
         y.idx - row_number() OVER (PARTITION BY y.doc_id, x.doc_id, y.idx - x.idx ORDER BY y.idx) AS run
  FROM b y JOIN b x ON x.line = y.line AND (x.doc_id < y.doc_id OR x.doc_id = y.doc_id AND x.idx < y.idx)
),
r AS (SELECT doc_id, min(pos) AS low, max(pos) AS high FROM e GROUP BY doc_id, early, apart, run HAVING sum(nw) >= 50),
gone AS (SELECT DISTINCT l.doc_id, l.pos FROM r JOIN l ON l.doc_id = r.doc_id AND l.pos BETWEEN r.low AND r.high)
SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id
"""
