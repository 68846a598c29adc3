import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from reelgap.llm import quality_rules
from tests.llm import test_line_dedup, test_near_dup, test_quality_rules, test_suffix_dedup

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def sample():
    rng = random.Random(9)
    words = [f"{a}{b}{c}" for a in "abcdef" for b in "aeiou" for c in "lmnrs"]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, banner = line(70), line(60)
    texts = ["\n".join(line(rng.randint(10, 40)) for _ in range(rng.randint(3, 6))) for _ in range(30)]
    texts += [texts[0], texts[1].replace(texts[1].split()[5], "changed", 1), "too short", None, "", "to " * 90, texts[2] + "\n" + banner, texts[3] + " " + passage, line(60) + " " + passage, texts[4] + "\n" + banner, banner]
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


def plain(rows):
    """What the filtering stages keep, by brute force, where the n-gram ratios reject nothing."""
    rows = [(i, t) for i, t, *_ in rows if not test_quality_rules.brute(t)[-1]]
    gone = test_line_dedup.maximal(rows, 50)
    cut = [(r[0], "\n".join(x for k, x in enumerate(r[1].split("\n")) if k not in gone[r])) for r in rows]
    rows = [c for c, r in zip(cut, rows, strict=True) if not gone[r] or c[1].strip()]
    kept = test_near_dup.brute(rows, 5, 80)
    rows = [r for r, k in zip(rows, kept, strict=True) if k[3]]
    cut = [(r[0], b[3].decode(errors="ignore"), b[1]) for r, b in zip(rows, test_suffix_dedup.brute([t for _, t in rows], 200), strict=True)]
    return [(i, t) for i, t, n in cut if not n or t.strip()]


def test_equals_the_plain_version(spark, tmp_path, monkeypatch):
    rows = sample()
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    monkeypatch.setattr(quality_rules.keep_good, "__defaults__", (-9.0,))
    folder = f"file://{tmp_path}"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = plain(rows)
    assert len(want) < len(rows) - 5
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.doc_tokens) for r in out if not r.start) == sorted((i, len(whole.encode(t, add_special_tokens=False).ids) + 1) for i, t in want)
    assert sum(r.length for r in out) == sum(len(whole.encode(t, add_special_tokens=False).ids) + 1 for _, t in want)


def test_repeated_rows_stay_once(spark, tmp_path, monkeypatch):
    text = {c: " ".join(f"{c}{i}" for i in range(80)) for c in "abcd"}
    rows = [(1, text["a"]), (1, text["a"]), (2, text["b"]), (2, text["b"] + " more"), (None, text["c"]), (None, text["c"] + " more"), (3, text["d"])]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    folder = f"file://{tmp_path}"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    out = sorted((str(r.doc_id), r.text) for r in docs.collect())
    assert [(i, t[0]) for i, t in out] == [("1", "a"), ("2", "b"), ("3", "d"), ("None", "c")] and {("1", text["a"]), ("3", text["d"])} < set(out)


def test_rules_reject_unlikely_text(spark):
    good = spark.createDataFrame([(i, f"clean words of story number {i} " * 20) for i in range(20)] + [(99, "x | y | " * 40 + " ".join(map(str, range(200))))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    kept = quality_rules.measures(good, quality_rules.log_ratios(good, labels)).where("kept").collect()
    assert 99 not in {r.doc_id for r in kept}


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0
