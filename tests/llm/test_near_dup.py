import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelgap.llm import near_dup
from reelgap.llm.components import components
from reelgap.llm.scratch import Scratch


def shingles(text, width):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent):
    """(doc_id, set size, component) of each row, from all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    of = list(range(len(rows)))

    def top(i):
        while of[i] != i:
            i = of[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                of[top(i)] = top(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(doc_id)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return [(str(d), len(s), str(least[top(i)]), d == least[top(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def sample(seed, n=150):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    while len(rows) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(x.upper() if rng.random() < 0.2 else x for x in copy))
    rng.shuffle(rows)
    return list(enumerate(rows))


ODD = [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "oNE"), (905, "É é"), (906, "é É"), (None, "One"), (907, "a b"), (908, "a\x0bb"), (909, "a b a b a b a b"), (910, "a b a b"), (3, "a b"), (911, "long " * 9000), (912, "long " * 8000), (912, "long " * 8000)]


@pytest.mark.parametrize("small,group", [(near_dup.SMALL, near_dup.GROUP), (3, near_dup.GROUP), (near_dup.SMALL, 1)])
def test_equals_brute_force(spark, monkeypatch, small, group):
    monkeypatch.setattr(near_dup, "SMALL", small)
    monkeypatch.setattr(near_dup, "GROUP", group)
    for width, percent in ((3, 85), (5, 80)) if small > 3 and group > 1 else ((3, 85),):
        rows = sample(width) + ODD
        docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("root", F.lit(1))
        got = [(str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dup.group(docs, width, percent).collect()]
        assert sorted(got) == sorted(brute(rows, width, percent))
        if small > 3 and group > 1:
            kept = near_dup.keep_one(docs, width, percent)
            assert kept.columns == docs.columns
            assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(r[0] for r in got if r[3])


def test_keeps_one_row_of_repeats(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(1, one, "x"), (1, one, "x"), (1, one, "w"), (2, two, "x"), (2, two + " more", "x"), (None, three, "x"), (None, three + " more", "x"), (None, None, "x"), (3, two, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = near_dup.keep_one(docs, 5, 80)
    assert kept.columns == docs.columns
    got = {tuple(r) for r in kept.collect()}
    assert kept.count() == 4 and {(1, one, "w"), (None, None, "x")} < got
    assert sorted((str(i), t[0]) for i, t, _ in got if t) == [("1", "a"), ("2", "b"), ("None", "c")]


def test_empty_table(spark):
    assert near_dup.group(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_branches_find_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(300):
        both = rng.integers(0, 1 << 63, 85, dtype=np.uint64)
        for _ in range(2):
            sets.append(np.unique(np.concatenate((both, rng.integers(0, 1 << 63, 7, dtype=np.uint64)))))
    signatures = near_dup.minwise(sets)
    assert abs((signatures[0::2] == signatures[1::2]).mean() - 85 / 99) < 0.01
    found = np.zeros(300, bool)
    for tree in range(near_dup.TREES):
        rows, nodes = near_dup.children(np.full(600, tree + 1, np.uint64), signatures, 85)
        for pair in range(300):
            found[pair] |= bool(set(nodes[rows == 2 * pair].tolist()) & set(nodes[rows == 2 * pair + 1].tolist()))
    assert found.all()


def test_deep_branches_find_pairs_too():
    """Recall of pairs at the threshold by all trees, at each depth: 0.99 and more."""
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(300):
        both = rng.integers(0, 1 << 63, 850, dtype=np.uint64)
        sets += [np.unique(np.concatenate((both, rng.integers(0, 1 << 63, 75, dtype=np.uint64)))) for _ in range(2)]
    signatures = near_dup.minwise(sets)
    at = [(np.arange(600), np.full(600, tree + 1, np.uint64)) for tree in range(near_dup.TREES)]
    for _ in range(14):
        found, below = np.zeros(300, bool), []
        for rows, nodes in at:
            chosen, child = near_dup.children(nodes, signatures[rows], 85)
            rows = rows[chosen]
            both = np.unique(np.stack((child, (rows // 2).astype(np.uint64), (rows % 2).astype(np.uint64)), 1), axis=0)
            same = (both[1:, :2] == both[:-1, :2]).all(1)
            found[both[1:][same][:, 1].astype(np.int64)] = True
            # only nodes that both have go on, as nothing else can be found below
            alive = set(map(tuple, both[1:][same][:, :2].tolist()))
            keep = np.array([(n, r // 2) in alive for n, r in zip(child.tolist(), rows.tolist(), strict=True)], bool)
            below.append((rows[keep], child[keep]))
        assert found.mean() >= 0.99
        at = below


def test_a_dense_node_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "SMALL", 40)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for _ in range(250):
        copy = list(base)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append(copy)
    for k in range(30):  # a copy of a copy, like few others, and some that are like none
        copy = list(rows[k])
        for _ in range(rng.randint(3, 9)):
            copy[rng.randrange(150)] = f"y{rng.randrange(10**6)}"
        rows.append(copy)
    rows = list(enumerate(" ".join(r) for r in rows))
    got = [(str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dup.group(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()]
    assert sorted(got) == sorted(brute(rows, 3, 85))


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 200)] + [(500, i) for i in range(501, 700)] + [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(100)] + [(9, 9)]
    out = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "c").collect()
    of = {r.v: r.root for r in out}
    assert len(of) == len(out) and all(of[a] == of[b] for a, b in edges if a != b)
    groups = {}
    for v, r in of.items():
        groups.setdefault(r, set()).add(v)
    want = {}
    for a, b in edges:
        if a != b:
            merged = want.get(a, {a}) | want.get(b, {b})
            for x in merged:
                want[x] = merged
    assert sorted(map(sorted, groups.values())) == sorted(map(list, {tuple(sorted(s)) for s in want.values()}))
