import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelgap.llm import suffix_dedup as sd


def brute(texts, length):
    """(bytes, removed, runs, kept) of each text, by counting every string."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(x[i : i + length] for x in data for i in range(len(x) - length + 1))
    out = []
    for x in data:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(x), sum(gone), runs, bytes(b for b, g in zip(x, gone, strict=True) if not g)))
    return out


def sample(seed, n, length):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(length // 2, 3 * length))) for _ in range(5)]
    out = []
    for _ in range(n):
        parts = ["".join(rng.choice("abcdefgh \n") for _ in range(rng.randint(0, 2 * length))) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice([*passages, "", ""]))
        out.append("".join(parts))
    return out + ["ab" * length, "x" * (length + 1), "x" * length, "y" * length, "abc" * (length // 3) + "ab", None, "", "\0" * 3 * length, out[0], out[1][3:], out[2] + "tail"]


@pytest.mark.parametrize("shard", [60, 1 << 16])
def test_merged_intervals_equal_counting(monkeypatch, shard):
    monkeypatch.setattr(sd, "SHARD", shard)
    rng = random.Random(shard)
    for _ in range(150):
        length = rng.choice([8, 12, 16, 20, 40, 41])
        texts = ["".join(rng.choice(rng.choice(["ab", "abcdef"])) for _ in range(rng.randint(0, 120))).encode() for _ in range(rng.randint(1, 7))]
        texts += [texts[0][2:] + b"!" + texts[-1], b"ab\0\0" * 20]
        weights = [rng.choice([1, 1, 3]) for _ in texts]
        seen = Counter()
        for x, w in zip(texts, weights, strict=True):
            for i in range(len(x) - length + 1):
                seen[x[i : i + length]] += w
        for x, ranges in zip(texts, sd.repeated(texts, weights, length), strict=True):
            assert [i for a, b in ranges for i in range(a, b)] == [i for i in range(len(x) - length + 1) if seen[x[i : i + length]] > 1]


def test_segments_keep_equal_strings_together():
    for seed in range(8):
        texts = [(t or "").encode() for t in sample(seed, 20, 24)]
        text, at, n, hashes, twice, _ = sd.segments(texts, 24, 8)
        owner, weight, places = {}, Counter(), set()
        for t, a, k, h, w in zip(text.tolist(), at.tolist(), n.tolist(), hashes.tolist(), twice.tolist(), strict=True):
            weight[h] += w
            for p in range(a, a + k):
                assert (t, p) not in places and len(texts[t][p : p + 24]) == 24
                places.add((t, p))
                assert owner.setdefault(texts[t][p : p + 24], h) == h
        assert len(places) == sum(max(0, len(x) - 23) for x in texts)
        seen = Counter(x[i : i + 24] for x in texts for i in range(len(x) - 23))
        assert all(weight[owner[s]] > 1 for s, k in seen.items() if k > 1)


@pytest.mark.parametrize("sizes", [{}, {"most": 300}, {"most": 41}, {"batch_bytes": 100, "most": 2000}])
def test_digests_equal_brute_force(spark, sizes):
    texts = sample(1, 60, 40)
    rows = list(enumerate(texts)) + [(None, texts[4] + "z"), (7, texts[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("hash", F.lit(1))
    want = [(str(i), n, gone, runs, hashlib.sha256(kept).hexdigest()) for (i, _), (n, gone, runs, kept) in zip(rows, brute([t for _, t in rows], 40), strict=True)]
    got = [(str(r.doc_id), *tuple(r)[1:]) for r in sd.digests(docs, length=40, gram=16, **sizes).collect()]
    assert sorted(got) == sorted(want)


def test_at_full_length(spark):
    texts = sample(2, 30, 200)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(i, n, gone, runs, hashlib.sha256(kept).hexdigest()) for i, (n, gone, runs, kept) in enumerate(brute(texts, 200))]
    assert sorted(map(tuple, sd.digests(docs).collect())) == want
    assert sd.digests(docs.limit(0)).count() == 0


def test_stage_keeps_columns(spark):
    texts = sample(3, 30, 40)
    docs = spark.createDataFrame([(i, t, "s", -1) for i, t in enumerate(texts)], "doc_id long, text string, key string, n_chars long")
    out = sd.keep_unrepeated(docs, length=40, gram=16)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    for i, (text, (_, gone, _, kept)) in enumerate(zip(texts, brute(texts, 40), strict=True)):
        kept = kept.decode(errors="ignore")
        if not gone:
            assert got[i].text == text and got[i].n_chars == -1
        elif kept.strip(" \t\n\r\x0b\x0c"):
            assert got[i].text == kept and got[i].n_chars == len(kept)
        else:
            assert i not in got
