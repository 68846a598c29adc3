"""Trigram matching holds against all pairs of a date, whatever grams the names share."""

import random

import pytest

from reelgap.operators import match


def grams(name):
    words = "".join(c if c.isalnum() else " " for c in name.lower()).split()
    return {p[i : i + 3] for w in words for p in [f"  {w} "] for i in range(len(p) - 2)}


def brute(coming, stored, warn, auto, ratio=0.70):
    out = set()
    for name, date in {r for r in coming if None not in r}:
        found = []
        for other, day in {r for r in stored if None not in r}:
            a, b = grams(name), grams(other)
            short, long = sorted((len(name.strip()), len(other.strip())))
            if day != date or not a | b or short / max(long, 1) < ratio or name.strip().lower() == other.strip().lower():
                continue
            same = len(a & b) / len(a | b)
            if same >= warn:
                found.append((-same, other))
        if found:
            same, other = min(found)
            out.add((name, date, other, round(-same, 9), "merge" if round(-same, 3) >= auto else "warn"))
    return out


@pytest.mark.parametrize("warn", [0.25, 0.5, 0.75, 1.0])
def test_trigram_matches_equal_all_pairs(spark, warn):
    rng = random.Random(4)
    words = ["the", "star", "stars", "river", "rivers", "night", "nights", "a", "ii", "aaa", "Élan"]
    names = lambda n: [(" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))), str(2000 + rng.randint(0, 2))) for _ in range(n)]
    odd = [("", "2000"), (" ", "2000"), ("!!", "2000"), (None, "2000"), ("star", None), (" Star ", "2000"), ("star-river", "2001"), ("river star", "2001")]
    coming, stored = names(120) + odd, names(120) + odd
    make = lambda rows: spark.createDataFrame(rows, "movie_name string, release_date string")
    got = [(*r[:3], round(r.similarity, 9), r.tier) for r in match.trigram_matches(make(coming), make(stored), warn, 0.9).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(coming, stored, warn, 0.9)
    assert match.trigram_matches(make([]), make(stored), warn).count() == 0
