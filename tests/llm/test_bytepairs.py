import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from reelgap.llm import bytepairs

PATHS = [public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.tiktoken")]


def library(path):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytepairs.read_ranks(path), special_tokens={})


def texts():
    rng = random.Random(3)
    letters = "abcdefghij theing  \n\t\r\x0b\x1c\x1f\x85   ,.!?<|>_-“”日本語éİ🙂ñßДжа12½٣'slld"
    found = ["", " ", "  ", "a   b", "a \n b ", "\n\n x", " lead", "trail ", "it's we'll", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 9, "=" * 200, "́e", "<|endoftext|>"]
    found += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(1500)]
    found += ["".join(chr(rng.choice([rng.randint(0, 0x7F), rng.randint(0, 0x3000), rng.randint(0x1F000, 0x1FFFF)])) for _ in range(40)) for _ in range(300)]
    found += ["".join(rng.choice(["th", "er", "ing", "on", "ré", "ße", "ción", "Ein", " "]) for _ in range(60)) for _ in range(500)]
    return found


@pytest.mark.parametrize("path", PATHS)
def test_equals_the_library(path):
    pairs, whole = bytepairs.BytePairs(bytepairs.read_ranks(path), public_tokenizers.PATTERN), library(path)
    for text in texts():
        ids = pairs.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode_ordinary(text), repr(text)
        assert b"".join(pairs.tokens[i] for i in np.frombuffer(ids, "<u4").tolist()) == text.encode()


def test_any_bytes_in_one_match():
    pairs, whole = bytepairs.BytePairs(bytepairs.read_ranks(PATHS[0]), public_tokenizers.PATTERN), library(PATHS[0])
    rng = random.Random(4)
    for _ in range(2000):
        data = bytes(rng.choice([rng.randint(0, 255), rng.randint(97, 102)]) for _ in range(rng.randint(1, 30)))
        assert pairs.merged(data) == whole._encode_single_piece(data) if data not in pairs.ranks else True


def test_query_columns(spark):
    rows = [(1, "Hello  wörld"), (2, None), (3, ""), (None, "x"), (None, "x"), (4, "long " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("n_tokens", F.lit(1))
    out = bytepairs.digest(bytepairs.decode(bytepairs.encode(docs, PATHS[0], public_tokenizers.PATTERN), PATHS[0]))
    whole = library(PATHS[0])
    want = []
    for doc_id, text in rows:
        ids = whole.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
    assert bytepairs.digest(bytepairs.decode(bytepairs.encode(docs.limit(0), PATHS[0], public_tokenizers.PATTERN), PATHS[0])).count() == 0
