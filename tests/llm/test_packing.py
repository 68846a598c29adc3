import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelgap.llm import packing, wordpieces

PATH = public_tokenizers.path("word_bpe_49k.json")


def one_by_one(lengths, window):
    """Best-fit decreasing as usually written: the multiset of what the sequences hold."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [x for x in left if x[0] >= n]
        if fits:
            tightest = min(fits)
            left.remove(tightest)
        else:
            tightest = (window, ())
        left.append((tightest[0] - n, (*tightest[1], n)))
    return sorted(x[1] for x in left)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(5)
    for _ in range(60):
        window = rng.choice([8, 13, 64])
        lengths = [rng.randint(1, window) for _ in range(rng.randint(0, 60))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        held = {}
        for length, low, high, first, each, offset in packing.plan(counts, window):
            for rank in range(low, high):
                held.setdefault(first + (rank - low) // each, []).append((offset + (rank - low) % each * length, length))
        for pieces in held.values():
            pieces.sort()
            assert [p for p, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
            assert sum(n for _, n in pieces) <= window
        assert sorted(sum(n for _, n in p) for p in held.values()) == sorted(map(sum, one_by_one(lengths, window)))


def test_wordpieces_equal_the_library():
    words, whole = wordpieces.Batches(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(1)
    letters = "abcXYZ éÉßçñ ΣΑς 'sll'd 12½٣ \n\t\r\x0b\x1c\x85   ,.!?<|>_-“”日本語 éİ🙂"
    texts = ["", " ", "a  b", "It's 'TIS we'LL", "<|endoftext|> x<|startoftext|>", "Ελληνικός ΟΔΟΣ. ΟΔΟΣ"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    for some in (texts, texts[::-1], [""], [], ["a"]):
        for text, ids in zip(some, words.encode([t.encode() for t in some]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_wordpieces_forget(monkeypatch):
    monkeypatch.setattr(wordpieces, "MEMO", 20)
    words, whole = wordpieces.Batches(PATH), Tokenizer.from_file(PATH)
    for k in range(30):
        texts = [" ".join(f"w{chr(97 + (k * i) % 26)}ord Ünd{k}" for i in range(9)), "", "the,end"]
        for text, ids in zip(texts, words.encode([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_spans_cut_before_spaces():
    text = "ab cde f " * 50
    assert "".join(wordpieces.spans(text, 7)) == text
    assert all(p[0] == " " for p in list(wordpieces.spans(text, 7))[1:])


def check(rows, docs, window):
    whole = Tokenizer.from_file(PATH)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in docs:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(by_doc[doc_id], key=lambda r: r.start)
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for own in by_seq.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) <= window


def test_pack(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["the", "film", "grosses", "Überraschung"]) for _ in range(rng.randint(0, 90)))) for i in range(200)]
    docs += [(1000, None), (1001, ""), (1002, "word " * 5000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("offset", F.lit(7)).withColumn("length", F.lit("x"))
    rows = packing.pack(df, PATH, window=64).collect()
    check(rows, docs, 64)
    assert len({r.sequence_id for r in rows}) * 64 - sum(r.length for r in rows) < 128


def test_pack_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(none, PATH).collect() == []
    twice = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None), (3, None)], "doc_id long, text string")
    rows = packing.pack(twice, PATH, window=16).collect()
    assert sorted((r.length, r.sequence_id, r.offset) for r in rows) == [(1, 0, 6), (1, 0, 7), (3, 0, 0), (3, 0, 3)]
