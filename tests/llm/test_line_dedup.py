import random
import re

from pyspark.sql import functions as F

from reelgap.llm import line_dedup


def maximal(rows, least):
    """Removed line places of each (doc_id, text): every pair of places is extended while the lines agree."""
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    gone, lines = {r: set() for r in docs}, {}
    for doc in docs:
        lines[doc] = [(i, x, n) for i, x in enumerate((doc[1] or "").split("\n")) if (n := len(re.findall(r"[^\x20\x09-\x0D]+", x)))]
    for k, later in enumerate(docs):
        for early in docs[: k + 1]:
            for a in range(len(lines[later])):
                for b in range(a if early == later else len(lines[early])):
                    n = 0
                    while a + n < len(lines[later]) and b + n < len(lines[early]) and lines[later][a + n][1] == lines[early][b + n][1]:
                        n += 1
                    run = lines[later][a : a + n]
                    if n and sum(x[2] for x in run) >= least:
                        gone[later] |= set(range(run[0][0], run[-1][0] + 1))
    return gone


def test_equals_brute_force(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(12)] + ["", "  ", "\t"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14)))) for i in range(80)]
    rows += [(100 + i, rows[i][1]) for i in range(10)] + [(200, None), (201, ""), (None, rows[3][1]), rows[5], rows[5], (202, "\n".join(["a b c"] * 300)), (203, "x " * 4000 + "\n" + "x " * 4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_key", F.lit("clash")).withColumn("h", F.lit(1)).withColumn("n_chars", F.lit(-1).cast("long"))
    for least in (1, 8):
        gone = maximal(rows, least)
        want = []
        for doc in rows:
            lines = (doc[1] or "").split("\n")
            kept = [x for i, x in enumerate(lines) if i not in gone[doc]]
            want.append((str(doc[0]), len(lines), len(lines) - len(kept), "\n".join(kept)))
        got = [(str(r.doc_id), r.n_lines, r.n_removed, r.text) for r in line_dedup.dedup(docs, least).collect()]
        assert sorted(got) == sorted(want), least
        stage = line_dedup.keep_first_runs(docs, least)
        assert stage.columns == docs.columns
        stays = [w for w, d in zip(want, rows, strict=True) if not gone[d] or w[3].strip()]
        assert sorted((str(r.doc_id), r.text or "") for r in stage.collect()) == sorted((w[0], w[3]) for w in stays)
    assert line_dedup.dedup(docs.limit(0)).count() == 0


def test_runs_go_whole(spark):
    long, short = " ".join(f"w{i}" for i in range(60)), "a tail of five words"
    docs = spark.createDataFrame([(1, f"{long}\n{short}"), (2, f"own line\n{long}\n{short}\nlast line")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.keep_first_runs(docs, 50).collect()} == {1: f"{long}\n{short}", 2: "own line\nlast line"}
    rng = random.Random(5)
    pool = [" ".join(rng.choice("abcd") for _ in range(rng.choice((1, 2, 9)))) for _ in range(8)] + ["", " "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for i in range(60)] + [(70, None), (None, "\n".join(pool))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (1, 8):
        gone = maximal(rows, least)
        want = [(str(d[0]), "\n".join(x for i, x in enumerate((d[1] or "").split("\n")) if i not in gone[d])) for d in rows]
        want = [w for w, d in zip(want, rows, strict=True) if not gone[d] or w[1].strip()]
        assert sorted((str(r.doc_id), r.text or "") for r in line_dedup.keep_first_runs(docs, least).collect()) == sorted(want), least
