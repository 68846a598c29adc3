import math
import random
import re

from pyspark.sql import functions as F

from reelgap.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = {}
    for g in grams:
        count[g] = count.get(g, 0) + 1
    inside = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), n < 50 or 100 * len(inside) > 50 * n


def texts():
    rng = random.Random(2)
    out = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a", "x\n x\nx\n\nx\n \n\n", "é🙂 é🙂\x85 b", "no\x0bw\x0c a\rb", "#a *b $c |<>%& d", "to " * 3000]
    out += [" ".join(rng.choice("abcde") for _ in range(rng.randint(1, 120))) for _ in range(60)]
    out += ["\n".join(" ".join(rng.choice(["ab", "cd", "ef", "g#h", "ñ"]) + str(rng.randint(0, 30)) for _ in range(rng.randint(0, 9))) for _ in range(20)) for _ in range(40)]
    return out


def test_counts_equal_brute_force(spark):
    rows = list(enumerate(texts())) + [(None, "a b c"), (None, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash")).withColumn("_row", F.lit(1)).withColumn("_text", F.lit(""))
    out = rules.measures(docs, [0.0] * 64).collect()
    got = sorted((str(r.doc_id), *map(str, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed))) for r in out)
    assert got == sorted((str(i), *map(str, brute(t))) for i, t in rows)
    assert all(r.kept == (not r.base_failed) for r in out)
    assert rules.measures(docs.limit(0), [0.0] * 64).count() == 0


def test_ratios_and_scores(spark):
    good = ["the film opened well " * 20] * 3
    bad = ["win | win | prize | " * 20] * 5
    docs = spark.createDataFrame(list(enumerate(good + bad)) + [(None, "the film"), (99, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, None), (1, 1, 0), (2, 1, 1), (3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    ratios = rules.log_ratios(docs, labels, n=64)
    # brute force: buckets from the same hash function, counts in Python
    h = {r.t: r.b for r in spark.createDataFrame([(t,) for t in {*good, *bad, "the film"}], "t string").select("t", rules.buckets(F.transform(rules.words(F.col("t")), lambda w: F.xxhash64(w)), 64).alias("b")).collect()}
    raw, trusted = [0] * 64, [0] * 64
    for t in [*good, *bad, "the film"]:
        for b in h[t]:
            raw[b] += 1
    for t in good[:2]:
        for b in h[t]:
            trusted[b] += 1
    mass = 10 * 64  # as many n-grams, spread like the raw ones, count as trusted
    smooth = [(t + mass * r / sum(raw)) / (sum(trusted) + mass) for t, r in zip(trusted, raw, strict=True)]
    want = [math.log(t / (r / sum(raw))) if r else 0.0 for t, r in zip(smooth, raw, strict=True)]
    assert all(abs(a - b) < 1e-9 for a, b in zip(ratios, want, strict=True))
    score = {r.doc_id: r.score for r in rules.measures(docs, ratios).collect()}
    assert abs(score[0] - sum(want[b] for b in h[good[0]]) / len(h[good[0]])) < 1e-9
    assert score[0] > 0 > score[5] and score[99] == 0
    assert rules.log_ratios(docs, labels.limit(0), n=64) == [0.0] * 64


def test_kept_rows_are_unchanged(spark):
    docs = spark.createDataFrame([(1, "a b c", "x"), (2, " ".join(map(str, range(80))), "y"), (3, None, "z")], "doc_id long, text string, _kept string")
    out = rules.keep_good(docs, [0.0] * 64)
    assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [tuple(docs.collect()[1])]


def test_all_trusted_documents_count(spark):
    ids = spark.range(20_001)
    docs = ids.select(F.col("id").alias("doc_id"), F.lit("word").alias("text"))
    labels = ids.select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert all(abs(r) < 1e-9 for r in rules.log_ratios(docs, labels, n=64))  # trusted and raw are the same


def test_little_trusted_text_rejects_little(spark):
    """Unlabelled text of the trusted kind stays, however few trusted documents there are; other text goes once there are enough."""
    rng = random.Random(6)
    kinds = [[f"w{i}" for i in range(3000)], [f"z{i}" for i in range(300)]]
    rows = [(i, " ".join(rng.choice(kinds[i % 10 == 9]) for _ in range(120))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for trusted in (3, 30, 200):
        labels = spark.createDataFrame([(i, 1, 0) for i in range(400) if i % 10 != 9][:trusted], "doc_id long, quality int, toxic int")
        kept = {r.doc_id for r in rules.measures(docs, rules.log_ratios(docs, labels)).collect() if r.kept}
        assert len(kept & {i for i in range(400) if i % 10 != 9}) >= 350
    assert not kept & {i for i in range(400) if i % 10 == 9}


def test_ids_beyond_the_broadcast_bound_are_joined_by_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i % 7} other") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 200, 3)], "doc_id long, quality int, toxic int")
    want = rules.log_ratios(docs, labels, n=64)
    monkeypatch.setattr(rules, "BROADCAST", 0)
    assert rules.log_ratios(docs, labels, n=64) == want


def test_verdicts_equal_brute_force_where_ratios_decide(spark):
    rng = random.Random(12)
    ratios = [rng.gauss(0, 0.3) for _ in range(64)]
    rows = [(i, " ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 40)) for _ in range(rng.randint(45, 200)))) for i in range(20)]
    rows += [(80, rows[0][1] + " " + " ".join(map(str, range(2_000)))), (81, None), (82, rows[1][1]), (82, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    own = {r.doc_id: r.b for r in docs.select("doc_id", rules.buckets(F.transform(rules.words(F.col("text")), lambda w: F.xxhash64(w)), 64).alias("b")).collect()}
    mean = {i: sum(ratios[b] for b in own[i]) / max(len(own[i]), 1) for i, _ in rows}
    for threshold in (-0.02, 0.01):
        got = sorted((r.doc_id, r.kept) for r in rules.measures(docs, ratios, threshold).collect())
        assert got == sorted((i, not brute(t)[-1] and mean[i] >= threshold) for i, t in rows)
        assert {k for _, k in got} == {True, False}
