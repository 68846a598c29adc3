import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from reelgap.llm import quality_classifier as qc
from reelgap.llm import wordhash
from reelgap.llm.scratch import table


def test_word_hashes_tell_words_apart():
    texts = ["", " ", "a b\ta", "\x85a b  b", "word", "x" * 3000 + " a"]
    hashes, starts = wordhash.words([t.encode() for t in texts])
    seen = {}
    for i, t in enumerate(texts):
        words = t.encode().split()
        own = hashes[starts[i] : starts[i + 1]].tolist()
        assert len(own) == len(words)
        for w, h in zip(words, own, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_dual_descent_finds_the_least_loss():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 120)
    rows = [np.unique(np.r_[rng.integers(0, 50, 8), 60 + c if rng.random() < 0.8 else 62]) for c in y]
    model = qc.fit(rows, y, epochs=300)
    again = qc.fit(rows, y, epochs=600, seed=1)
    assert np.allclose(model["weights"], again["weights"], atol=1e-2)
    assert np.mean([(s >= 0.5) == c for s, c in zip(qc.score(model, rows), y, strict=True)]) > 0.75


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    out = qc.classify(docs, qc.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    good, bad = [r for r in out if r.quality == 1], [r for r in out if r.quality == 0]
    assert np.mean([r.predicted for r in good]) > 0.95 and np.mean([r.predicted for r in bad]) < 0.15


def test_odd_tables(spark):
    rng = random.Random(1)
    rows = [(i, "TO! TO! TO!" if i % 2 else " ".join(rng.choice("abcdefg") for _ in range(20))) for i in range(60)] + [(None, "a"), (None, "a"), (99, None), (98, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("_id", F.lit(1))
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)] + [(None, 1), (5, None), (7, 0)], "doc_id long, quality int")
    out = qc.classify(docs, qc.train(docs, labels)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == 1 - r.doc_id % 2 for r in out if r.doc_id is not None and r.doc_id < 60)
    assert qc.classify(docs.limit(0), qc.train(docs.limit(0), labels)).count() == 0
    only = qc.train(docs, labels.where("quality = 1"))
    assert {r.predicted for r in qc.classify(docs, only).collect()} == {1}


def test_fit_equals_a_plain_solver():
    """Against dense indicators, ratios by their definition and accelerated projected gradients on the dual."""
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 90)
    rows = [np.unique(np.r_[rng.integers(0, 40, 6), 50 + c if rng.random() < 0.7 else 52]) for c in y]
    x = np.zeros((90, qc.DIMENSIONS))
    for i, r in enumerate(rows):
        x[i, r] = 1
    good, bad = 1 + x[y == 1].sum(0), 1 + x[y == 0].sum(0)
    ratio = np.log(good / good.sum()) - np.log(bad / bad.sum())
    v = np.c_[(x * ratio)[:, :60] / np.sqrt(x.sum(1))[:, None], np.ones(90)]
    z = v * np.where(y == 1, 1.0, -1.0)[:, None]
    most = 0.1 * 90 / (2 * np.where(y == 1, (y == 1).sum(), (y == 0).sum()))
    q = z @ z.T
    step, a, ahead, t = 1 / np.linalg.eigvalsh(q)[-1], np.zeros(90), np.zeros(90), 1.0
    for _ in range(5_000):
        now, later = np.clip(ahead - step * (q @ ahead - 1), 0, most), (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, a, t = now + (t - 1) / later * (now - a), now, later
    want = v @ (a @ z)
    model = qc.fit(rows, y, epochs=400)
    got = [model["weights"][r].sum() / np.sqrt(len(r)) + model["offset"] for r in rows]
    assert np.allclose(got, want, atol=1e-4)


def test_very_long_texts_are_scored_whole(spark):
    long = "plain words of a story " * 50_000
    ends = " SALE! SALE! | WIN | $$$"
    model = {"weights": np.random.default_rng(1).normal(size=qc.DIMENSIONS), "offset": 0.0, "slope": 1.0, "intercept": 0.0}
    docs = spark.createDataFrame([(1, long), (2, long + ends), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in qc.classify(docs, model).collect()}
    want = [qc.score(model, qc.features([t.encode()]))[0] for t in (long, long + ends, "")]
    assert [got[i] for i in (1, 2, 3)] == want and got[1] != got[2]
