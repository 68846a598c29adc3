"""Packing of documents into token windows by best-fit decreasing.

Tokenising cuts a document into full windows and one rest, so a piece's length is at most the window. Best-fit
decreasing treats pieces of one length alike: what it does follows from *how many* pieces each length has, and
that is at most ``window`` numbers, whatever the size of the corpus. The driver replays best-fit decreasing on
these counts, with a segment tree over remaining capacities that finds the tightest open windows; a step places a
range of ranks of one length into consecutive windows. Executors then look up their pieces' ranks in the steps.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelgap.llm import wordhash
from reelgap.llm.scratch import Scratch

#: Pieces of one length are ranked in parts of about so many.
PART = 20_000


class TightestOpen:
    """Segment tree over capacities 0..size: which of them have an open window."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        at = self.leaves + capacity
        self.any[at] = is_open
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def at_least(self, capacity: int) -> int | None:
        """The smallest open capacity that is no smaller."""
        at = self.leaves + capacity
        while not self.any[at]:
            while at & 1:  # a right child: nothing larger below this parent
                at //= 2
            if at == 0:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        return at - self.leaves


def plan(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``counts`` pieces of each length.

    A step (length, first rank, end rank, first sequence, pieces per sequence, first offset) places pieces side by
    side. The tightest window keeps receiving pieces of a length while they fit, since what is left of it is
    tighter still than any other window that was open.
    """
    steps, opened, tree, sequences = [], {}, TightestOpen(window), 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            if (capacity := tree.at_least(length)) is None:
                capacity, each = window, window // length
                first, n = sequences, -(-left // each)
                sequences += n
            else:
                each = capacity // length
                first, n = opened[capacity].pop()
                if (needed := -(-left // each)) < n:
                    opened[capacity].append((first + needed, n - needed))
                    n = needed
                elif not opened[capacity]:
                    tree.set(capacity, False)
            placed = min(left, n * each)
            steps.append((length, rank, rank + placed, first, each, window - capacity))
            full, rest = divmod(placed, each)
            for start, many, used in ((first, full, each), (first + full, 1, rest)):
                if many and used and (now := capacity - used * length):
                    opened.setdefault(now, []).append((start, many))
                    tree.set(now, True)
            rank, left = rank + placed, left - placed
    return steps


def tokenised(docs: DataFrame, tokenizer_path: str, window: int, end_id: int) -> DataFrame:
    """A row for each piece of a document: cut into full windows and a rest."""

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from reelgap.llm import wordpieces

        words, end = wordpieces.load(tokenizer_path), end_id.to_bytes(4, "little")
        for batch in batches:
            out: list[tuple] = []
            for chunk in wordhash.chunks(zip(batch.column(0).to_pylist(), ((t.as_py() or "").encode() for t in batch.column(1)), strict=True)):
                for (doc_id, _), ids in zip(chunk, words.encode([t for _, t in chunk]), strict=True):
                    total, ids = len(ids) // 4 + 1, ids + end
                    for at in range(0, total, window):
                        part = ids[4 * at : 4 * (at + window)]
                        out.append((doc_id, at, len(part) // 4, zlib.crc32(part), total))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 5, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, tokenizer_path: str, window: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) with their places in sequences of at most ``window`` ids.

    A null text is empty and has the end id only; a text of any length is cut into windows; a null doc_id stays null;
    repeated rows are packed each; other columns are not read; an empty table gives no rows. Pieces of one length are
    ranked within parts by doc_id, start and checksum, so ties are between rows that are alike.
    """
    spark = docs.sparkSession
    pieces = Scratch(spark, "packing").keep(tokenised(docs, tokenizer_path, window, end_id).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # window rows at most
    # one length may hold a third of all pieces: each has a part for PART pieces, so there are window + pieces / PART parts at most
    parts = F.from_json(F.lit(json.dumps([1 + counts.get(n, 0) // PART for n in range(window + 1)])), "array<int>")
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("_row"), F.get(parts, F.col("length").cast("int"))))
    sizes = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("base"))
    steps = spark.createDataFrame(plan(counts, window), "length long, rank_from long, rank_to long, first_sequence long, each long, first_offset long")
    ranked = pieces.withColumn("nth", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32", "doc_tokens", "_row")) - 1)
    ranked = ranked.join(F.broadcast(before), ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    placed = ranked.join(F.broadcast(steps), "length").where("rank >= rank_from and rank < rank_to")
    nth = F.col("rank") - F.col("rank_from")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first_sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + nth % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )
