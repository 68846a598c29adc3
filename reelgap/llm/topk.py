"""Exact top-k inner products with an impact-ordered index, score at a time.

A component's integer is quantised to an impact. A block of candidates keeps posting segments: for a component and a
signed impact, the candidates that have it. A search takes the segments from the largest impact to the smallest and
adds each to the scores of its candidates only. For every candidate and impact the index knows the length of what the
scores don't have yet, later segments and roundings alike, so by Cauchy and Schwarz a score is off by that times the
query's length at most. A search stops on the proof that few candidates can still be among the best, or where the
segments end; these are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Candidates of an index block, queries that are answered together, and blocks that a task keeps at most, about.
BLOCK, QUERIES, KEPT = 2048, 512, 16
#: Impacts that a block's components are quantised to, and how many of them lie between two looks at the bounds.
IMPACTS, LOOK = 16, 4
#: Rescore once at most this share of a block's candidates is possible.
SHARE = 0.02


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v array<bigint>): floor(scale * x) of each component; rows without an id, without components or with a null or non-finite component take no part."""
    x = F.col(vector_col)
    usable = F.col(id_col).isNotNull() & (F.size(x) > 0) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("v"))


class Block:
    """Candidates, their posting segments in falling order of impact, and how long what comes after each impact is."""

    def __init__(self, ids: np.ndarray, v: np.ndarray) -> None:
        self.ids, self.v = ids, v
        size = np.abs(v)
        step = int(size.max()) // IMPACTS + 1
        impact = size // step
        #: (impact, [(component, signed value, its candidates)]), largest first; impact 0 has no segments
        self.segments = []
        #: For each of them, the length of what the scores lack of each candidate once its segments are added.
        self.lacking = [np.sqrt((v.astype(np.float64) ** 2).sum(1))]
        seen = np.zeros(v.shape, np.int64)
        for a in range(int(impact.max()), 0, -1):
            value, own = a * step + step // 2, []
            for sign in (1, -1):
                at, of = np.nonzero(((impact == a) & (np.sign(v) == sign)).T)
                ends = np.searchsorted(at, np.arange(v.shape[1] + 1))
                own += [(j, sign * value, of[ends[j] : ends[j + 1]].astype(np.int32)) for j in np.flatnonzero(np.diff(ends)).tolist()]
                seen[of, at] = sign * value
            self.segments.append((a, own))
            self.lacking.append(np.sqrt(((v - seen).astype(np.float64) ** 2).sum(1)))


def search(query_ids: np.ndarray, q: np.ndarray, block: Block, k: int, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions (query, candidate) and exact scores of all that may be among each query's ``k`` best.

    ``known`` are scores that each query needs at least, from blocks already searched.
    """
    n, lengths = len(block.ids), np.sqrt((q.astype(np.float64) ** 2).sum(1))
    scores = np.zeros((n, len(q)), np.int64)
    other = block.ids[:, None] != query_ids[None, :]
    columns = np.ascontiguousarray(q.T)
    for i, (_, segments) in enumerate(block.segments, 1):
        for j, value, candidates in segments:
            scores[candidates] += value * columns[j]
        if i % LOOK and i < len(block.segments):
            continue
        possible = _possible(scores, lengths, block.lacking[i], other, k, known)
        if possible.mean() <= SHARE:
            break
    else:
        if not block.segments:
            possible = other
    of, at = np.nonzero(possible)
    exact = np.zeros(len(at), np.int64)
    for low in range(0, len(at), 65536):
        cut = slice(low, low + 65536)
        exact[cut] = np.einsum("ij,ij->i", q[at[cut]], block.v[of[cut]].astype(np.int64))
    return at, of, exact


def _possible(scores: np.ndarray, lengths: np.ndarray, lacking: np.ndarray, other: np.ndarray, k: int, known: np.ndarray | None) -> np.ndarray:
    """Which candidates may reach each query's ``k``-th best score."""
    off = lacking[:, None] * lengths[None, :] * (1 + 1e-9) + 1e-6
    floor = np.full(len(lengths), -np.inf) if known is None else known
    if len(scores) > k:
        least = np.where(other, scores - off, -np.inf)
        floor = np.maximum(floor, np.partition(least, len(least) - k, axis=0)[len(least) - k])
    return other & (scores + off >= floor[None, :])


def best(at: np.ndarray, ids: np.ndarray, scores: np.ndarray, n_queries: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best candidates of each query, ties to the smaller id."""
    order = np.lexsort((ids, -scores, at))
    at, ids, scores = at[order], ids[order], scores[order]
    starts = np.searchsorted(at, np.arange(n_queries))
    keep = np.arange(len(at)) - starts[at] < k
    return at[keep], ids[keep], scores[keep]


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """(width, ids, tags, kind, v): rows (id, tag, v) of one width side by side; ``kind`` is the integers' size in bytes."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds, names = [pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary()], ["width", "ids", "tags", "kind", "v"]

        def full(width: int, held: list):
            v = np.array([v for *_, v in held], np.int64).reshape(-1, width)
            kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= v.min() and v.max() <= np.iinfo(t).max)
            row = width, np.array([i for i, *_ in held], np.int64).tobytes(), np.array([t for _, t, _ in held], np.int64).tobytes(), np.dtype(kind).itemsize, v.astype(kind).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=names)

        waiting: dict[int, list] = {}
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                held = waiting.setdefault(len(row[2]), [])
                held.append(row)
                if len(held) == size:
                    yield full(len(row[2]), waiting.pop(len(row[2])))
        for width, held in waiting.items():
            yield full(width, held)

    return rows.select("id", "tag", "v").mapInArrow(run, "width int, ids binary, tags binary, kind int, v binary")


def _answers(batches: Iterator, k: int) -> Iterator:
    """Top ``k`` within a task's blocks, from rows sorted by (dealt, width, is_query): blocks are kept, queries pass by."""
    import pyarrow as pa

    kept, own = [], None
    for batch in batches:
        for dealt, width, is_query, ids, tags, kind, v in zip(*(batch.column(i) for i in range(7)), strict=True):
            if (group := (dealt.as_py(), width.as_py())) != own:
                kept, own = [], group
            ids = np.frombuffer(ids.as_py(), np.int64)
            v = np.frombuffer(v.as_py(), f"i{kind.as_py()}").reshape(len(ids), -1).astype(np.int64)
            if not is_query.as_py():
                kept.append(Block(ids, v))
                continue
            found, known = [np.zeros(0, np.int64)] * 3, None
            for block in kept:
                at, of, scores = search(ids, v, block, k, known)
                found = best(np.concatenate((found[0], at)), np.concatenate((found[1], block.ids[of])), np.concatenate((found[2], scores)), len(ids), k)
                many = np.bincount(found[0], minlength=len(ids))
                known = np.full(len(ids), -np.inf)
                known[many == k] = found[2][np.cumsum(many)[many == k] - 1]
            tags = np.frombuffer(tags.as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[found[0]], tags[found[0]], found[1], found[2])], names=["query_id", "tag", "vec_id", "score"])


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best candidates of each row whose id is divisible by ``every``.

    Candidates are all rows of other ids and of the query's width. Rows without an id or without usable components
    take no part, however wide. A repeated row is a candidate each time but a query once; different vectors under one id
    are different queries, each with ranks of its own. Ties go to the smaller id; an empty table gives no rows; other
    columns are not read.
    """
    rows = integers(vectors, id_col, vector_col, scale).withColumn("tag", F.xxhash64("v"))
    n = rows.count()
    groups = max(1, -(-n // (BLOCK * KEPT)), min(-(-n // BLOCK), vectors.sparkSession.sparkContext.defaultParallelism))
    index = _blocks(rows, BLOCK).select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("dealt"), "width", F.lit(False).alias("is_query"), "ids", "tags", "kind", "v")
    queries = _blocks(rows.where(F.col("id") % every == 0).distinct(), QUERIES)
    queries = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("dealt"), "width", F.lit(True).alias("is_query"), "ids", "tags", "kind", "v")
    dealt = index.unionByName(queries).repartition(groups, "dealt").sortWithinPartitions("dealt", "width", "is_query")
    found = dealt.mapInArrow(lambda batches: _answers(batches, k), "query_id long, tag long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "tag").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The same rows as op10_exact_top_k, as DuckDB reads it.
SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
),
q AS (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 20 = 0),
s AS (
  SELECT q.vec_id AS query_id, q.e, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
  FROM q JOIN v ON v.vec_id <> q.vec_id AND len(v.e) = len(q.e)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
