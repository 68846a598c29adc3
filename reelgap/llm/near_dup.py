"""MinHash near-duplicates by a chosen-path set similarity join.

Documents with equal shingle sets are one class; the join is between classes. A class has ``COORDINATES`` minwise
hashes. Every tree sends a class down the branches of coordinates that the node itself chooses, on average one over
the threshold, so a pair at the threshold keeps one common path in expectation; nodes with few classes are compared
exhaustively on their sketches, larger ones branch again, and independent trees make a miss as unlikely as wanted.
What a node hands on is a spanning forest of its similar pairs. Classes that these forests connect and that share a
node are then brought together with their whole texts, and every pair of two different components that may be similar
is confirmed on the full sets.

A large node that branching no longer divides, as a large group of near copies, is compared in blocks: first every
class with a fixed number of representatives, then what these did not join to the node's largest component with
every class. That finds all links between the components of the node, in bounded tasks whose number grows with the
node, unless it really falls into large parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgap.llm import hotkeys, wordhash
from reelgap.llm.components import components
from reelgap.llm.scratch import Scratch, release_shuffles

COORDINATES, TREES = 128, 16
#: Nodes of at most so many classes are compared exhaustively, as are blocks of that size; a larger node that keeps more than this share of the node above it is compared in blocks.
SMALL, DENSE = 4000, 0.7
#: Sketches that agree in fewer coordinates than the threshold less this many standard deviations are not compared further.
DEVIATIONS = 5
#: Shingles that a task confirms together, about; a group with more is confirmed in pairs of blocks.
GROUP = 2_000_000

_RANDOM = np.random.Generator(np.random.PCG64(77))
_MULTIPLY = (_RANDOM.integers(0, 1 << 31, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_FLIP = _RANDOM.integers(0, 1 << 32, COORDINATES, dtype=np.uint64).astype(np.uint32)
_ORDER = [np.uint64(x) for x in _RANDOM.integers(1 << 60, 1 << 62, 16).tolist()]


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text: of its words if they are fewer than ``width``, none without words."""
    hashes, starts = wordhash.words([t.translate(wordhash.LOWER) for t in texts])
    whole = np.zeros(max(len(hashes) - width + 1, 0), np.uint64)
    for k in range(width):
        whole += hashes[k : k + len(whole)] * (_ORDER[k] * np.uint64(2) + np.uint64(1))
    whole = wordhash.mix(whole)
    for low, high in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        n = high - low
        if n >= width:
            yield np.unique(whole[low : high - width + 1])
        elif n:
            short = np.uint64(n)
            with np.errstate(over="ignore"):
                for k in range(n):
                    short += hashes[low + k] * (_ORDER[k] * np.uint64(2) + np.uint64(1))
            yield wordhash.mix(np.array([short]) ^ np.uint64(0xABCDEF))
        else:
            yield np.zeros(0, np.uint64)


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, COORDINATES) minwise hashes; the sets aren't empty."""
    low = np.concatenate(sets).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), COORDINATES), np.uint32)
    for c in range(COORDINATES):
        x = (low ^ _FLIP[c]) * _MULTIPLY[c]
        x ^= x >> np.uint32(15)
        out[:, c] = np.minimum.reduceat(x * np.uint32(0x2C1B3C6D), starts)
    return out


def children(nodes: np.ndarray, signatures: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) of every branch that each row's node chooses: one coordinate, and with the rest of the probability a second."""
    out = []
    for salt in (1, 2):
        key = wordhash.mix(nodes + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        chosen = np.flatnonzero((key >> np.uint64(40)) % np.uint64(1000) < np.uint64(1000 * (100 - percent) // percent)) if salt == 2 else np.arange(len(nodes))
        coordinate = (key[chosen] % np.uint64(COORDINATES)).astype(np.int64)
        value = signatures[chosen, coordinate].astype(np.uint64)
        out.append((chosen, wordhash.mix(key[chosen] ^ wordhash.mix(value + np.uint64(0x51ED27)))))
    return np.concatenate([r for r, _ in out]), np.concatenate([n for _, n in out])


def least_agreement(percent: int) -> int:
    p = percent / 100
    return int(np.ceil(COORDINATES * p - DEVIATIONS * np.sqrt(COORDINATES * p * (1 - p))))


def forest(sketches: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the rows that agree in ``least`` coordinates or more."""
    left, edges = np.arange(len(sketches)), []
    while len(left) > 1:
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            at = reached.pop()
            close = (sketches[left] == sketches[at]).sum(1) >= least
            edges += [(at, int(x)) for x in left[close]]
            reached += left[close].tolist()
            left = left[~close]
    return edges


def confirmed(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the sets whose Jaccard similarity is ``percent`` / 100 or more, decided on the full sets."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    sketches, least, of = minwise(sets).astype(np.uint8) if n > 8 else None, least_agreement(percent), np.arange(n)
    edges = []
    for at in range(n):
        other = np.flatnonzero((of != of[at]) & (100 * np.minimum(sizes, sizes[at]) >= percent * np.maximum(sizes, sizes[at])))
        if sketches is not None and len(other):
            other = other[(sketches[other] == sketches[at]).sum(1) >= least]
        if len(other):
            both = shared(sets[at], [sets[x] for x in other.tolist()])
            for x in other[100 * both >= percent * (sizes[at] + sizes[other] - both)].tolist():
                if of[x] != of[at]:
                    edges.append((at, x))
                    of[of == of[x]] = of[at]
            if (of == of[at]).all():
                break
    return edges


def shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many members each of ``others`` has in common with ``one``; all are sorted, distinct and not empty."""
    out, low = [], 0
    while low < len(others):
        high, n = low, 0
        while high < len(others) and (high == low or n + len(others[high]) <= 1 << 18):
            n += len(others[high])
            high += 1
        values = np.concatenate(others[low:high])
        hit = one[np.minimum(np.searchsorted(one, values), len(one) - 1)] == values
        out.append(np.add.reduceat(hit.astype(np.int64), np.cumsum([0] + [len(s) for s in others[low : high - 1]])))
        low = high
    return np.concatenate(out)


def _groups(batches: Iterator, columns: int) -> Iterator[tuple[int, list[tuple]]]:
    """(group, rows) of batches that are sorted by their first column."""
    group, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(columns)), strict=True):
            if row[0] != group:
                if rows:
                    yield group, rows
                group, rows = row[0], []
            rows.append(row)
    if rows:
        yield group, rows


def _edge_batch(edges: list[tuple]):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], names=["a", "b"])


def signed(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, key, n, set_id, signature, sketch) of each row; no set_id, signature and sketch for an empty set."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds, names = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()], ["doc_id", "key", "n", "set_id", "signature", "sketch"]
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), ((t.as_py() or "").encode() for t in batch.column(2)), strict=True)
            for chunk in wordhash.chunks(rows):
                sets = list(shingle_sets([t for *_, t in chunk], width))
                full = [s for s in sets if len(s)]
                signatures = iter(minwise(full) if full else ())
                own = [next(signatures) if len(s) else None for s in sets]
                ids = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                columns = [c[0] for c in chunk], [c[1] for c in chunk], [len(s) for s in sets], ids, [x if x is None else x.tobytes() for x in own], [x if x is None else x.astype(np.uint8).tobytes() for x in own]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return keyed(docs).mapInArrow(run, "doc_id long, key binary, n long, set_id binary, signature binary, sketch binary")


def _key() -> Column:
    """128 bits of doc_id and text: rows that repeat both are alike."""
    doc_id, text = F.col("doc_id").cast("long").cast("string"), F.col("text").cast("string")
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")))))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, key, text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key().alias("key"), F.col("text").cast("string").alias("text"))


def similar_nodes(classes: DataFrame, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(node, class_id, n) of the small nodes of all trees that have more than one class, and of dense ones; n is the node's size."""

    def branch(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            signatures, above = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, COORDINATES), batch.column(2).to_numpy()
            for tree in range(TREES) if batch.num_columns == 3 else (None,):
                nodes = np.full(len(ids), wordhash.mix(np.array([tree + 1], np.uint64))[0]) if tree is not None else batch.column(3).to_numpy().view(np.uint64)
                rows, child = children(nodes, signatures, percent)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(ids[rows]), pa.array(above[rows])], names=["node", "class_id", "above"])

    small, dense, rows = [], [], classes.select("class_id", "signature", F.lit(classes.count()).cast("long").alias("above"))
    for depth in count(1):
        level = scratch.keep(rows.mapInArrow(branch, "node long, class_id long, above long"), f"branched{depth}")
        sizes = level.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        kept = scratch.keep(hotkeys.joined(level, sizes, ["node"], level.count()), f"level{depth}")
        scratch.drop(f"branched{depth}")
        small.append(kept.where(F.col("n") <= SMALL).select("node", "class_id", "n"))
        large = kept.where(F.col("n") > SMALL)
        if large.isEmpty():
            break
        whole = F.col("n") > DENSE * F.col("above")
        dense.append(large.where(whole).select("node", "class_id", "n"))
        rows = classes.select("class_id", "signature").join(large.where(~whole).select("class_id", F.col("n").alias("above"), "node"), "class_id").select("class_id", "signature", "above", "node")
    none = small[0].where(F.lit(False))
    return _union(small), _union([none, *dense])


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out


def _block(n: Column) -> Column:
    """The block of a class in its node, of ``n`` blocks."""
    return F.pmod(F.xxhash64("node", "class_id"), n)


def with_representatives(dense: DataFrame) -> DataFrame:
    """(node, class_id) of blocks of dense nodes, each with the node's first block beside it."""
    blocks = F.ceil(F.col("n") / SMALL)
    rows = dense.select("node", "class_id", blocks.alias("blocks"), _block(blocks).alias("block"))
    rows = rows.select("node", "class_id", F.explode(F.when(F.col("block") == 0, F.sequence(F.lit(1).cast("long"), F.greatest(F.col("blocks") - 1, F.lit(1)))).otherwise(F.array("block"))).alias("to"))
    return rows.select(F.xxhash64("node", "to", F.lit("first")).alias("node"), "class_id")


def with_the_rest(dense: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, class_id) of blocks of dense nodes, each with a block of what isn't in the node's largest component beside it."""
    labelled = dense.join(roots.withColumnRenamed("v", "class_id"), "class_id", "left").withColumn("root", F.coalesce("root", "class_id"))
    labelled = scratch.keep(labelled, "labelled")
    parts = labelled.groupBy("node", "root").agg(F.count(F.lit(1)).alias("m"))
    largest = parts.groupBy("node").agg(F.max(F.struct("m", "root")).alias("top"), F.sum("m").alias("n"))
    largest = largest.select("node", "n", F.col("top.root").alias("largest"), F.ceil((F.col("n") - F.col("top.m")) / SMALL).alias("rests")).where("rests > 0")
    rows = hotkeys.joined(labelled.select("node", "class_id", "root"), largest, ["node"], labelled.count())
    blocks = F.ceil(F.col("n") / SMALL)
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    every = rows.select("node", "class_id", _block(blocks).alias("block"), F.explode(upto(F.col("rests"))).alias("rest"))
    rest = rows.where("root <> largest").select("node", "class_id", F.explode(upto(blocks)).alias("block"), _block(F.col("rests")).alias("rest"))
    return every.unionByName(rest).select(F.xxhash64("node", "block", "rest", F.lit("rest")).alias("node"), "class_id").distinct()


def _confirmed_links(nodes: DataFrame, classes: DataFrame, docs: DataFrame, rows: DataFrame, width: int, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """(a, b): links between the classes of each node (node, class_id), enough to join what belongs together."""
    least = least_agreement(percent)

    def connect(batches: Iterator) -> Iterator:
        for _, own in _groups(batches, 3):
            sketches = np.frombuffer(b"".join(s for *_, s in own), np.uint8).reshape(len(own), -1)
            if edges := forest(sketches, least):
                yield _edge_batch([(own[a][1], own[b][1]) for a, b in edges])

    sketched = nodes.join(classes.select("class_id", "sketch").hint("merge"), "class_id").select("node", "class_id", "sketch")
    near = scratch.keep(sketched.repartition("node").sortWithinPartitions("node", "class_id").mapInArrow(connect, "a long, b long").distinct(), f"near{name}")
    clusters = components(near, scratch, f"clusters{name}").withColumnRenamed("v", "class_id")
    # the members of a cluster in a node are a group; nodes with the same members need one of them only
    members = scratch.keep(nodes.join(clusters, "class_id").join(classes.select("class_id", "key", "n"), "class_id"), f"members{name}")
    groups = members.groupBy("node", "root").agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("class_id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "class_id")).alias("y")).where("many > 1")
    groups = groups.groupBy("root", "many", "total", "x", "y").agg(F.min("node").alias("node"))
    groups = groups.select("node", "root", F.least(F.col("many"), F.ceil(F.col("total") / F.lit(GROUP / 2))).alias("blocks"))
    own = F.pmod(F.xxhash64("class_id", "node"), F.col("blocks"))
    grouped = members.join(groups, ["node", "root"]).select("key", "class_id", "node", "root", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    grouped = grouped.select("key", "class_id", F.xxhash64("node", "root", F.least("own", "other"), F.greatest("own", "other")).alias("group"))
    grouped = scratch.keep(grouped, f"grouped{name}")
    copies = grouped.select("key").distinct().join(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key")
    texts = hotkeys.joined(keyed(docs).select("key", "text"), scratch.keep(copies, f"copies{name}"), ["key"], rows.count(), always_shuffle=True).dropDuplicates(["key"]).select("key", "text")
    texts = texts.join(grouped.hint("merge"), "key").select("group", "class_id", "text")

    def confirm(batches: Iterator) -> Iterator:
        for _, own in _groups(batches, 3):
            sets = [s for chunk in wordhash.chunks((c, t.encode()) for _, c, t in own) for s in shingle_sets([t for _, t in chunk], width)]
            if edges := confirmed(sets, percent):
                yield _edge_batch([(own[a][1], own[b][1]) for a, b in edges])

    sure = scratch.keep(texts.repartition("group").sortWithinPartitions("group", "class_id").mapInArrow(confirm, "a long, b long").distinct(), f"sure{name}")
    scratch.drop(*[f"{t}{name}" for t in ("near", "members", "grouped", "copies")])
    release_shuffles(scratch.spark)
    return sure


def links(docs: DataFrame, width: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, roots): what ``signed`` gives without signature and sketch, (class_id, set_id, n) of each class, and (class_id, root) of classes linked with others."""
    rows = scratch.keep(signed(docs, width), "rows")
    classes = rows.where("set_id is not null").groupBy("set_id").agg(F.min("key").alias("key"), F.max("n").alias("n"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"))
    classes = scratch.keep(classes.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    small, dense = similar_nodes(classes, percent, scratch)
    nodes = small.select("node", "class_id").unionByName(with_representatives(dense))
    sure = _confirmed_links(nodes, classes, docs, rows, width, percent, scratch, "")
    roots = components(sure, scratch, "roots")
    if not dense.isEmpty():
        more = _confirmed_links(scratch.keep(with_the_rest(dense, roots, scratch), "rest"), classes, docs, rows, width, percent, scratch, "_rest")
        roots = components(sure.unionByName(more), scratch, "all_roots")
    return rows.drop("signature", "sketch"), classes, roots.withColumnRenamed("v", "class_id")


def _least(docs: DataFrame, width: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(rows, least): ``rows`` of ``links``, and for each set_id the first (no_id, doc_id, key) of its component.

    First is the smallest doc_id (a null one only if there is no other), then the smallest key.
    """
    rows, classes, roots = links(docs, width, percent, scratch)
    own = rows.where("set_id is not null").groupBy("set_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("own"))
    own = scratch.keep(own.join(classes.select("set_id", "class_id"), "set_id").join(roots, "class_id", "left"), "own")
    linked = own.where("root is not null")
    first = linked.groupBy("root").agg(F.min("own").alias("least"), F.count(F.lit(1)).alias("n"))
    of_linked = hotkeys.joined(linked.select("set_id", "root"), first, ["root"], linked.count()).select("set_id", "least")
    least = scratch.keep(own.where("root is null").select("set_id", F.col("own").alias("least")).unionByName(of_linked), "least")
    scratch.drop("own", "classes", "rest", "labelled")
    return rows, least


def group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, key, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text).

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; sets are distinct shingles of ``width``
    words, or the whole sequence of fewer words. Two documents are linked if 100 * intersection >= ``percent`` *
    union. component_id is the smallest doc_id that links reach, the row's own included. A null or empty text has an
    empty set and is linked with nothing; a text of any length is taken whole; equal sets are linked, so repeated rows
    are; a row with a null doc_id links others but its doc_id is never the smallest; other columns are not read; an
    empty table gives no rows.
    """
    rows, least = _least(docs, width, percent, Scratch(docs.sparkSession, "near_dup"))
    out = rows.join(least, "set_id", "left").withColumn("component_id", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")))
    return out.select("doc_id", "key", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component that ``group`` finds, all columns unchanged, and every row with an empty set.

    It is that of the smallest doc_id (a null one only if there is no other), then of the smallest key; of rows that
    repeat doc_id and text, the one whose columns come first as JSON.
    """
    scratch = Scratch(docs.sparkSession, "near_dup")
    rows, least = _least(docs, width, percent, scratch)
    copies = rows.where("set_id is not null").groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    first = least.select("least.key").distinct().join(copies, "key")
    empty = rows.where("set_id is null").select("key", F.lit(1).cast("long").alias("copies")).distinct()
    kept = scratch.keep(first.unionByName(empty).withColumnRenamed("key", "_key"), "kept")
    keyed_rows = docs.select(F.struct("*").alias("_row"), _key().alias("_key"))
    out = keyed_rows.join(kept.where("copies = 1"), "_key", "left_semi").select("_row.*")
    repeated = kept.where("copies > 1")
    if repeated.isEmpty():
        return out
    one = keyed_rows.join(repeated, "_key", "left_semi").groupBy("_key").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return out.unionByName(one.select("_row.*"))
