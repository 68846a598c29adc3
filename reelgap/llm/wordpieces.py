"""Fast exact tokenisation with a word-level BPE file of the ``tokenizers`` library.

White space always ends a pre-token, so a text's ids are those of its chunks between white space, one after the
other. Chunks of ASCII and Latin-1 letters are cut into pre-tokens for many texts at once with array operations;
pre-tokens not met before are merged together, one merge of each per round. All other chunks go to the library.
Both ways remember what they have seen, up to a fixed number of entries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from reelgap.llm import wordhash

#: Entries kept by each memo of a worker; a full one is emptied.
MEMO = 300_000
#: Characters of a text that are split at a time.
SPAN = 1 << 20


def spans(text: str, size: int = SPAN) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut before spaces only."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def byte_letters() -> list[str]:
    """The printable stand-in of each byte that byte-level BPE files use."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class WordPieces(dict):
    """Chunk -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.pieces: dict[str, bytes] = {}
        self.letters = byte_letters()
        # Fixed: the pre-token pattern of the vocabulary file.
        self.pre = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        self.plain = regex.compile(r"[\x21-\x7eÀ-ſ]+")

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        if "<|" in chunk or not self.plain.fullmatch(chunk):  # special tokens and rarer scripts: the library itself
            found = self.pack(self.whole.encode(chunk, add_special_tokens=False).ids) if chunk else b""
        else:
            found = b"".join([self.piece(p) for p in self.pre.findall(chunk.lower())])
        if len(chunk) <= 64:
            self[chunk] = found
        return found

    def piece(self, piece: str) -> bytes:
        if (found := self.pieces.get(piece)) is None:
            if len(self.pieces) >= MEMO:
                self.pieces.clear()
            shown = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
            found = self.pack([t.id for t in self.model.tokenize(shown)])
            if len(piece) <= 64:
                self.pieces[piece] = found
        return found

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        return np.asarray(ids, dtype="<u4").tobytes()


# Kinds of bytes: white space, letters, digits, marks, and what the array way leaves to the library.
SPACE, LETTER, DIGIT, MARK, OTHER = range(5)
KIND = np.full(256, OTHER, np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = SPACE
for _b in range(33, 127):
    KIND[_b] = LETTER if chr(_b).isalpha() else DIGIT if chr(_b).isdigit() else OTHER if chr(_b) in "'<" else MARK
LOWER = np.frombuffer(wordhash.LOWER, np.uint8)
#: First byte of the letters from U+00C0 on, whose second byte is one of SECOND.
LATIN = 0xC3
SECOND = np.zeros(256, bool)
SECOND[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True


class Merges:
    """The vocabulary's merges as a hash table from pairs of ids, and byte-pair merging of many pre-tokens at once."""

    def __init__(self, path: str) -> None:
        import json

        with open(path) as f:
            model = json.load(f)["model"]
        ids, letters = model["vocab"], byte_letters()
        end = model["end_of_word_suffix"] or ""
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.last = np.array([ids[c + end] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] << 20 | ids[b] for a, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.bits = max(12, len(pairs).bit_length() + 2)
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        for rank, (key, new, slot) in enumerate(zip(keys.tolist(), made.tolist(), self._slot(keys).tolist(), strict=True)):
            while self.keys[slot] not in (-1, key):
                slot = (slot + 1) & (1 << self.bits) - 1
            if self.keys[slot] < 0:
                self.keys[slot], self.values[slot] = key, rank << 20 | new

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    NEVER = 1 << 50

    def of(self, keys: np.ndarray) -> np.ndarray:
        """rank << 20 | merged id of each pair, NEVER for pairs that don't merge."""
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], self.NEVER)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (1 << self.bits) - 1
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def apply(self, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each) of the non-empty pre-tokens data[first : first + size]."""
        starts = np.cumsum(size) - size
        symbols = data[np.repeat(first - starts, size) + np.arange(size.sum())]
        at_end = starts + size - 1
        last = symbols[at_end]
        symbols = self.inner[symbols]
        symbols[at_end] = self.last[last]
        which, left = np.arange(len(size)), size.copy()
        done_ids, done_word, counts = [], [], size.copy()
        while len(which):
            starts = np.cumsum(left) - left
            worth = np.full(len(symbols), self.NEVER, np.int64)
            if len(symbols) > 1:
                worth[:-1] = self.of(symbols[:-1] << 20 | symbols[1:])
            worth[starts + left - 1] = self.NEVER
            best = np.minimum.reduceat(worth, starts)
            going = best < self.NEVER
            if not going.all():
                over = np.repeat(~going, left)
                done_ids.append(symbols[over])
                done_word.append(np.repeat(which[~going], left[~going]))
                counts[which[~going]] = left[~going]
                symbols, worth = symbols[~over], worth[~over]
                which, left, best = which[going], left[going], best[going]
                starts = np.cumsum(left) - left
            if not len(which):
                break
            same = np.flatnonzero(worth == np.repeat(best, left))
            word = np.repeat(np.arange(len(left)), left)[same]
            here = same[np.concatenate(([True], word[1:] != word[:-1]))]  # the leftmost of each word
            symbols[here] = best & (1 << 20) - 1
            keep = np.ones(len(symbols), bool)
            keep[here + 1] = False
            symbols, left = symbols[keep], left - 1
        words = np.concatenate(done_word)
        order = np.argsort(words, kind="stable")
        return np.concatenate(done_ids)[order].astype(np.uint32), counts


class Batches:
    """Ids of many texts at once."""

    def __init__(self, path: str) -> None:
        self.rare = WordPieces(path)
        self.merges = Merges(path)
        self._forget()

    def _forget(self) -> None:
        self.known, self.at, self.size, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> None:
        ids, counts = self.merges.apply(data, first, size)
        known = np.concatenate((self.known, hashes))
        order = np.argsort(known, kind="stable")
        at = np.concatenate((self.at, len(self.pool) + np.cumsum(counts) - counts))
        self.known, self.at, self.size = known[order], at[order], np.concatenate((self.size, counts))[order]
        self.pool = np.concatenate((self.pool, ids))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        kind = KIND[data]
        low = LOWER[data]
        at = np.flatnonzero(data[:-1] == LATIN)
        at = at[SECOND[data[at + 1]]]
        kind[at] = kind[at + 1] = LETTER
        capital = at[data[at + 1] < 0x9F] + 1
        low[capital] += 0x20
        space = kind == SPACE
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
        chunk_from, chunk_to = edge[0::2], edge[1::2]
        others = np.concatenate(([0], np.cumsum(kind == OTHER)))
        rare = others[chunk_to] > others[chunk_from]
        starts = np.empty(len(kind), bool)
        starts[0] = True
        np.not_equal(kind[1:], kind[:-1], out=starts[1:])
        starts |= kind == DIGIT
        if rare.any():  # a rare chunk is one item
            for a, b in zip(chunk_from[rare].tolist(), chunk_to[rare].tolist(), strict=True):
                starts[a:b] = False
                starts[a] = True
        first = np.flatnonzero(starts & ~space)
        stop = np.flatnonzero(np.concatenate((starts[1:] | space[1:], [True])) & ~space) + 1
        up, down = wordhash._powers(len(data) + 1)
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(wordhash.LETTERS[low] * up[: len(data)], out=sums[1:])
        hashes = wordhash.mix((sums[stop] - sums[first]) * down[first])
        is_rare = np.zeros(len(first), bool)
        is_rare[np.searchsorted(first, chunk_from[rare])] = True
        plain = np.flatnonzero(~is_rare)
        unique, one, back = np.unique(hashes[plain], return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.known, unique), max(len(self.known) - 1, 0))
        new = np.flatnonzero(self.known[place] != unique) if len(self.known) else np.arange(len(unique))
        if len(new):
            if len(self.known) + len(new) > MEMO:  # forgotten: all of these are new
                self._forget()
                new = np.arange(len(unique))
            here = plain[one[new]]
            self._learn(unique[new], low, first[here], stop[here] - first[here])
            place = np.searchsorted(self.known, unique)
        item_at, item_size = np.empty(len(first), np.int64), np.empty(len(first), np.int64)
        if len(plain):
            item_at[plain], item_size[plain] = self.at[place][back], self.size[place][back]
        pool = self.pool
        if rare.any():
            own = [self.rare[data[a:b].tobytes().decode()] for a, b in zip(chunk_from[rare].tolist(), chunk_to[rare].tolist(), strict=True)]
            sizes = np.array([len(o) // 4 for o in own], np.int64)
            item_size[is_rare], item_at[is_rare] = sizes, len(pool) + np.cumsum(sizes) - sizes
            pool = np.concatenate((pool, np.frombuffer(b"".join(own), "<u4")))
        before = np.cumsum(item_size) - item_size
        ids = pool[np.repeat(item_at - before, item_size) + np.arange(item_size.sum())].astype("<u4")
        cut = np.concatenate((before, [len(ids)]))[np.searchsorted(first, np.concatenate(([0], ends)))]
        return [ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]


_LOADED: dict[str, Batches] = {}


def load(path: str) -> Batches:
    """One per worker process: what it remembers outlives a task."""
    if path not in _LOADED:
        _LOADED[path] = Batches(path)
    return _LOADED[path]
