"""Byte-level BPE encoding and decoding in linear time.

The vocabulary's tokens, as Latin-1 strings, go into an Aho-Corasick automaton that gives the longest token
ending at each byte, and so the longest token that starts at each byte of the reversed walk. Encoding tries the
longest token at a position and falls back to shorter ones; a token may follow another only if the merges would
leave that pair apart. That test depends on the two tokens alone and is remembered. The walk with these two
rules gives the ids that merging pairs by rank gives, without a queue of merges.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgap.llm.wordpieces import spans

#: Entries kept by each memo of a worker; a full one is emptied.
MEMO = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class BytePairs(dict):
    """Chunk of text -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import ahocorasick
        import regex

        super().__init__()
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.doubled = regex.compile(r"\s\s")
        self.matches: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        #: Reversed tokens: the longest that ends at a byte of the reversed input is the longest that starts there.
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in ranks.items():
            self.automaton.add_word(token[::-1].decode("latin-1"), rank)
        self.automaton.make_automaton()
        #: Each token's longest proper prefix that is a token, -1 without one.
        self.shorter = {rank: next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), -1) for token, rank in ranks.items()}
        self.parts = self._parts()

    def _parts(self) -> dict[int, tuple[int, int]]:
        """The two tokens whose merge makes each token: found with the tokens of lower rank, in order of rank."""
        parts: dict[int, tuple[int, int]] = {}
        self.split = parts
        for token, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            parts[rank] = (rank, rank)
            for n in range(len(token) - 1, 0, -1):
                left, right = self.ranks.get(token[:n], rank), self.ranks.get(token[n:], rank)
                if left < rank and right < rank and self.apart(left, right, rank):
                    parts[rank] = (left, right)
                    break
        self.pairs.clear()
        return parts

    def apart(self, left: int, right: int, limit: int | None = None) -> bool:
        """Whether ``left`` then ``right`` stay two tokens, counting merges of rank under ``limit`` only.

        Undo the two tokens' merges from the last one back. Where the tokens that touch could merge at a rank below
        that of the merge undone last, merging by rank would have joined across the border first.
        """
        ranks, tokens, split = self.ranks, self.tokens, self.split
        most = 1 << 40 if limit is None else limit
        while True:
            across = ranks.get(tokens[left] + tokens[right])
            if across is not None and across < most:
                return False
            if left > right:
                most = left
                left = split[left][1]
                if left == most:
                    most = right + 1
                    right, before = split[right][0], right
                    if right == before:
                        return True
            else:
                most = right + 1
                right, before = split[right][0], right
                if right == before:
                    most = left
                    left = split[left][1]
                    if left == most:
                        return True

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the two stay apart, remembered under both ranks as one number."""
        if len(self.pairs) >= MEMO:
            self.pairs.clear()
        found = self.pairs[left << 20 | right] = self.apart(left, right)
        return found

    def merged(self, data: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        return self._walk(len(data), self._longest(data))

    def _longest(self, data: bytes) -> dict[int, int]:
        """The longest token that starts at each place, by the place's distance from the last byte.

        The automaton gives the words that end at a place from the longest to the shortest; read backwards, the
        longest is what stays.
        """
        return dict(reversed([*self.automaton.iter(data[::-1].decode("latin-1"))]))

    def _walk(self, size: int, longest: dict[int, int]) -> list[int]:
        lengths, shorter, pairs, follows = self.lengths, self.shorter, self.pairs, self.may_follow
        dead, out, at, last = set(), [], 0, size - 1
        token = longest[last]
        while True:
            end = at + lengths[token]
            if end not in dead and (not out or (pairs.get(out[-1] << 20 | token) or (out[-1] << 20 | token not in pairs and follows(out[-1], token)))):
                out.append(token)
                at = end
                if at == size:
                    return out
                token = longest[last - at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:  # no token fits here: this position is never right
                dead.add(at)
                token = out.pop()
                at -= lengths[token]

    def match(self, match: str) -> bytes:
        if (found := self.matches.get(match)) is None:
            if len(self.matches) >= MEMO:
                self.matches.clear()
            ids = self.merged(match.encode())
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(match) <= 64:
                self.matches[match] = found
        return found

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        found = b"".join([self.match(m) for m in self.pattern.findall(chunk)])
        if len(chunk) <= 64:
            self[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        """Where no two white-space characters meet, a space begins a match and chunks can be looked up; else the whole text is matched."""
        if self.doubled.search(text):
            return b"".join([self.match(m) for m in self.pattern.findall(text)])
        get, out = self.__getitem__, []
        for part in spans(text):
            first, *rest = part.split(" ")
            out.append(get(first) if first else b"")
            out += [get(" " + x) for x in rest]
        return b"".join(out)


_LOADED: dict[tuple[str, str], BytePairs] = {}


def load(path: str, pattern: str) -> BytePairs:
    """One per worker process: the memos outlive a task."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = BytePairs(read_ranks(path), pattern)
    return _LOADED[path, pattern]


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids binary): the ids of each whole text of ``docs``, little-endian unsigned 32-bit.

    A null text is empty and has no ids; a null doc_id stays null; repeated rows give repeated rows; other columns
    are not read.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        pairs = load(ranks_path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((pairs.encode(t.as_py() or "") for t in batch.column(1)), pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, ids, decoded binary): the bytes that ``ids`` stand for; null ids stay null."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        tokens = {rank: token for token, rank in read_ranks(ranks_path).items()}
        for batch in batches:
            ids = (i.as_py() for i in batch.column(1))
            own = (None if i is None else b"".join([tokens[k] for k in np.frombuffer(i, "<u4").tolist()]) for i in ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digest(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of (doc_id, ids, decoded)."""
    return decoded.select("doc_id", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
