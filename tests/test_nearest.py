"""Nearest names hold against all pairs, and their work doesn't grow with the number of pairs."""

import random

import numpy as np
import pytest

from reelgap.operators import match, nearest
from reelgap.plans import catalogue


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def trie(names, length):
    return nearest.Trie(np.array([x.encode() for x in names], f"S{length}"), length)


@pytest.mark.parametrize(("cells", "share"), [(1 << 21, 100.0), (20, 100.0), (1, 0.0), (30, 0.5), (30, 3.0)])
def test_nearest_equals_all_pairs(monkeypatch, cells, share):
    monkeypatch.setattr(nearest, "CELLS", cells)  # small: walks are cut into parts, or given up for whole tables
    monkeypatch.setattr(nearest, "SHARE", share)
    monkeypatch.setattr(nearest, "LEAST", 1)
    monkeypatch.setattr(nearest, "BATCH", 40)
    rng = random.Random(cells)
    for _ in range(60):
        m, n, letters = rng.randint(0, 9), rng.randint(0, 9), rng.choice(["a", "ab", "abcdef"])
        some = lambda size: sorted({"".join(rng.choice(letters) for _ in range(size)) for _ in range(rng.randint(1, 25))})
        a, b, most = some(m), some(n), rng.randint(0, 8)
        ranks = rng.sample(range(len(b)), len(b))
        best = [min((edits(x, y), ranks[j], j) for j, y in enumerate(b)) for x in a]
        i, j = nearest.nearest(trie(a, m), trie(b, n), np.array(ranks), most)
        assert len(i) == len(set(i.tolist()))
        assert dict(zip(i.tolist(), j.tolist())) == {k: y for k, (d, _, y) in enumerate(best) if d <= most}


def test_work_follows_the_names(monkeypatch):
    """Twice the names on both sides are four times the pairs, but about twice the cells."""
    made, plain = [0], nearest._smallest
    monkeypatch.setattr(nearest, "_smallest", lambda *parts: (made.__setitem__(0, made[0] + sum(map(len, parts[0]))), plain(*parts))[1])
    monkeypatch.setattr(nearest, "_dense", lambda *_: pytest.fail("the walk was given up"))
    seen = []
    for size in (4000, 8000):
        made[0] = 0
        i, _ = nearest.nearest(trie([f"customer {x:09}" for x in range(size)], 18), trie([f"supplier {x:09}" for x in range(size)], 18), np.arange(size), 7)
        assert len(i) == size
        seen.append(made[0])
    assert seen[1] < 3 * seen[0] and seen[1] < 8000 * 8000 / 50


@pytest.mark.parametrize("few", [0, 1 << 8])
def test_best_by_name_equals_all_pairs(spark, monkeypatch, few):
    monkeypatch.setattr(match, "LEFT", 7)
    monkeypatch.setattr(match, "RIGHT", 5)
    monkeypatch.setattr(match, "FEW", few)
    rng = random.Random(3)
    some = lambda: "".join(rng.choice("abc 1") for _ in range(rng.randint(0, 9)))
    left = [(some(), rng.choice([1, 2])) for _ in range(80)] + [(None, 1), ("", 2), ("Ab-C", None), ("AB c", 1), ("x" * 300, 1)]
    right = [(some(), rng.choice([1, 2])) for _ in range(60)] + [(None, 2), ("!!", 2), ("ab c", None), ("a. b", 1), ("A b", 1), ("é b", 1), ("x" * 290 + "y" * 9, 1)]
    plain = lambda x: " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in x.lower()).split())
    want = []
    for name, group in left:
        scores = []
        for other, block in right:
            if None in (name, other, group) or block != group:
                continue
            a, b = plain(name), plain(other)
            longer, shorter = max(len(a), len(b), 1), min(len(a), len(b))
            score = 1.0 if a == b else 0.0 if shorter / longer < 0.4 else 1.0 - edits(a, b) / longer
            if score >= 0.6:
                scores.append((-score, other))
        if scores:
            score, other = min(scores)
            want.append((name, group, other, -score))
    make = lambda rows, name: spark.createDataFrame(rows, f"{name} string, g int")
    got = match.best_by_name(make(left, "l"), make(right, "r"), "l", "r", ["g"], 0.4, 0.6, ["l", "g"]).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    alone = match.best_by_name(make([], "l"), make(right, "r"), "l", "r", [], 0.4, 0.6, ["l"])
    assert alone.columns == ["l", "r", "score"] and alone.count() == 0
    assert match.best_by_name(make(left, "l"), make([], "r"), "l", "r", [], 0.4, 0.6, ["l"]).count() == 0


def test_an_actor_listed_twice_comes_once(spark, tmp_path):
    spark.createDataFrame([("Customer#1",), ("Customer#1",), (None,)], "c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([("Customer#2",), ("Customer#3",)], "s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    rows = catalogue.QUERIES["q_actor_slug_match_guard04"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("Customer#1", "Customer#2", 0.9)]
