import math
import random

import numpy as np
from pyspark.sql import functions as F

from reelgap.llm import topk


def brute(rows, k, every, scale=64):
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for qi, q in ok:
        if qi % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in ok if i != qi and len(v) == len(q))
            out |= {(qi, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


def run(spark, rows, k, every, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("id", F.lit(1)).withColumn("score", F.lit(2))
    return topk.top_k(df, k=k, every=every).collect()


def test_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2001, [None] * 8), (2002, [math.nan] + [0.0] * 7), (2020, [math.inf] + [0.0] * 7), (None, [0.1] * 8), (2040, [0.5] * 3), (2041, [0.25, -0.5, 1.0])]
    got = run(spark, rows, 5, 20)
    assert {tuple(r) for r in got} == brute(rows, 5, 20) and len(got) == len({tuple(r) for r in got})


def test_large_numbers_and_few_rows(spark):
    rows = [(0, [1e7, -3e7]), (20, [2e7, 5.0]), (3, [-1e7, 1e7])]
    assert {tuple(r) for r in run(spark, rows, 5, 20, "double")} == brute(rows, 5, 20)
    assert run(spark, [], 5, 20) == [] and run(spark, [(0, [0.5])], 5, 20) == []
    assert run(spark, [(0, []), (1, [])], 5, 20) == []


def test_vectors_that_share_an_id_are_queries_of_their_own(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(1, 19)] + [(20, [0.5, 0.5, 0.0, 0.0]), (20, [-0.5, 0.25, 1.0, 0.0]), (20, [0.5, 0.5, 0.0, 0.0])]
    got = sorted(map(tuple, run(spark, rows, 5, 20, "double")))
    want = []
    for q in {tuple(v) for i, v in rows if i == 20}:
        want += [(20, *r[1:]) for r in brute([(20, list(q)), *rows[:18]], 5, 20)]
    assert got == sorted(want) and len(got) == 10


def test_stops_early_and_stays_exact():
    rng = np.random.default_rng(2)
    v = np.floor(rng.normal(0, 8, (3000, 64))).astype(np.int64)
    v[:200] = v[0] + rng.integers(-1, 2, (200, 64))
    block = topk.Block(np.arange(3000), v)
    at, of, scores = topk.search(np.arange(50), v[:50], block, 20)
    assert len(at) < 0.1 * 50 * 3000
    full = v[:50] @ v.T
    at, found, scores = topk.best(at, of, scores, 50, 20)
    for i in range(50):
        want = sorted((-full[i, j], j) for j in range(3000) if j != i)[:20]
        assert list(zip((-scores[at == i]).tolist(), found[at == i].tolist(), strict=True)) == [(int(a), int(b)) for a, b in want]


def test_segments_stand_for_every_component():
    v = np.array([[5, -300, 0, 17], [0, 0, 0, 0], [-16, 299, 1, 2]])
    block = topk.Block(np.arange(3), v)
    sums = np.zeros(v.shape, np.int64)
    for i, (_, segments) in enumerate(block.segments, 1):
        for j, value, candidates in segments:
            sums[candidates, j] += value
        assert np.allclose(block.lacking[i], np.sqrt(((v - sums) ** 2).sum(1)))
    impacts = [a for a, _ in block.segments]
    assert impacts == sorted(impacts, reverse=True) and abs(v - sums).max() <= 300 // topk.IMPACTS + 1
