"""A quality classifier: naive Bayes support vectors over n-gram indicators.

A text's features are the n-grams it has, hashed: its words, three flags in a row of whether a word repeats the one
before, and four-grams over classes of characters (so shouting, bars and marks between words, or a word said again
and again show in any language). An indicator is scaled by the log ratio of its counts in the two classes, and a
linear model with hinge loss is fitted to the scaled indicators by dual coordinate descent. The fit sees a bounded
sample of labelled rows; all rows are scored, over their whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgap.llm import wordhash

DIMENSIONS = 1 << 16
#: The fit sees so many labelled rows of each class at most: those with the smallest hashes of doc_id.
PER_CLASS = 2500

_CLASSES = np.zeros(256, np.uint64)
for _b in range(256):
    _c = chr(_b)
    _CLASSES[_b] = 1 if _b >= 128 or _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c in " \t\r\x0b\x0c" else 5 if _c == "\n" else 6 + _b % 58


def _runs(data: np.ndarray) -> np.ndarray:
    """Character classes, with runs of one class of letters or digits made one."""
    kinds = _CLASSES[data]
    keep = np.ones(len(kinds), bool)
    keep[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] > 3)
    return kinds[keep]


def features(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted feature numbers of each text."""
    hashes, starts = wordhash.words([t.translate(wordhash.LOWER) for t in texts])
    d = np.uint64(DIMENSIONS // 2)
    for i, text in enumerate(texts):
        own = hashes[starts[i] : starts[i + 1]]
        found = [(own % d).astype(np.int64)]
        again = (own[1:] == own[:-1]).astype(np.uint64)
        kinds = _runs(np.frombuffer(text, np.uint8))
        grams = [kinds[k : len(kinds) - 3 + k] for k in range(4)] if len(kinds) >= 4 else []
        for salt, parts in ((1, [again[k : len(again) - 2 + k] for k in range(3)] if len(again) >= 3 else []), (2, grams)):
            if parts:
                key = np.full(len(parts[0]), salt, np.uint64)
                for p in parts:
                    key = key * np.uint64(67) + p
                found.append((wordhash.mix(key) % d + d).astype(np.int64))
        yield np.unique(np.concatenate(found))


def fit(rows: list[np.ndarray], labels: np.ndarray, penalty: float = 0.1, epochs: int = 12, seed: int = 7) -> dict:
    """Weights of the indicators, offset, and the slope and intercept that turn a margin into a probability.

    Without rows of both classes every score is the share of label 1 (one half without any rows).
    """
    y = np.where(np.asarray(labels) == 1, 1.0, -1.0)
    if len(set(y.tolist())) < 2:
        share = 0.5 if not len(y) else float(y[0] > 0)
        return {"weights": np.zeros(DIMENSIONS), "offset": 0.0, "slope": 0.0, "intercept": 0.0 if share == 0.5 else 4.0 * y[0]}
    counts = {s: np.ones(DIMENSIONS) for s in (1.0, -1.0)}
    for row, s in zip(rows, y, strict=True):
        counts[s][row] += 1
    ratio = np.log(counts[1.0] / counts[1.0].sum()) - np.log(counts[-1.0] / counts[-1.0].sum())
    values = [ratio[r] / np.sqrt(max(len(r), 1)) for r in rows]
    norms = np.array([v @ v + 1.0 for v in values])
    n_good = (y > 0).sum()
    most = np.where(y > 0, penalty * len(y) / (2 * n_good), penalty * len(y) / (2 * (len(y) - n_good)))
    w, b, alpha, rng = np.zeros(DIMENSIONS), 0.0, np.zeros(len(y)), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            gradient = y[i] * (values[i] @ w[rows[i]] + b) - 1
            now = min(max(alpha[i] - gradient / norms[i], 0.0), most[i])
            if now != alpha[i]:
                step = (now - alpha[i]) * y[i]
                w[rows[i]] += step * values[i]
                b += step
                alpha[i] = now
    margins = np.array([v @ w[r] + b for v, r in zip(values, rows, strict=True)])
    slope, intercept = _platt(margins, y > 0)
    return {"weights": w * ratio, "offset": b, "slope": slope, "intercept": intercept}


def _platt(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the class on the margin, by Newton steps, with smoothed targets and classes weighed alike."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(good, 0.5 / n1, 0.5 / n0)
    x = np.stack([margins, np.ones(len(margins))])
    found = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(found @ x, -30, 30)))
        hessian = (x * (weight * p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        found = found - np.clip(np.linalg.solve(hessian, x @ (weight * (p - target)) + 1e-6 * found), -1, 1)
    return float(found[0]), float(found[1])


def score(model: dict, rows: Iterator[np.ndarray]) -> list[float]:
    margins = np.array([model["weights"][r].sum() / np.sqrt(max(len(r), 1)) + model["offset"] for r in rows])
    return (1 / (1 + np.exp(-np.clip(model["slope"] * margins + model["intercept"], -30, 30)))).tolist()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict:
    """Fit on rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, quality) has and that are not held out.

    At most ``per_class`` rows of each class are read; a doc_id with several labels has the smallest; a null doc_id
    or label has no part in it.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").alias("_label"))
    known = known.where(~held_out(F.col("_id")))
    parts = [known.where(F.col("_label") == c).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for c in (0, 1)]
    sample = parts[0].unionByName(parts[1])
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")).join(F.broadcast(sample), "_id")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            items = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), (t.as_py().encode() for t in batch.column(2)), strict=True)
            for chunk in wordhash.chunks(items):
                own = [r.astype("<u4").tobytes() for r in features([t for *_, t in chunk])]
                yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in chunk], pa.int64()), pa.array([c[1] for c in chunk], pa.int32()), pa.array(own, pa.binary())], names=["id", "label", "features"])

    found = rows.select("_id", F.col("_label").cast("int"), "_text").mapInArrow(run, "id long, label int, features binary").toArrow()
    got = sorted(zip(*(c.to_pylist() for c in found.columns), strict=True))
    return fit([np.frombuffer(f, "<u4").astype(np.int64) for *_, f in got], np.array([c for _, c, _ in got]))


def classify(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted, for each row of ``docs``.

    A null text is empty; empty texts are scored, and texts of any length whole; a null doc_id stays null and isn't
    held out; repeated rows are scored each and equal scores stay equal; other columns are not read; an empty table
    gives no rows.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for chunk in wordhash.chunks(zip(batch.column(0).to_pylist(), ((t.as_py() or "").encode() for t in batch.column(1)), strict=True)):
                yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in chunk], pa.int64()), pa.array(score(model, features([t for _, t in chunk])))], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
