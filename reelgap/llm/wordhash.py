"""Hashes of the words of many texts at once, with array operations only.

A word is a run of bytes other than ASCII white space, [^\\x20\\x09-\\x0D]+. Its hash is a polynomial in a fixed odd
base over random 64-bit letters, modulo 2**64, taken from running sums over the whole buffer and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes of text handled at a time (a longer text is handled alone).
CHUNK = 1 << 20
_RANDOM = np.random.Generator(np.random.PCG64(20240501))
LETTERS = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(int(_RANDOM.integers(1 << 40, 1 << 62)) * 4 + 1)
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, CHUNK + (CHUNK >> 2))
        for name, base in (("up", BASE), ("down", np.uint64(pow(int(BASE), -1, 1 << 64)))):
            line = np.full(size, base, np.uint64)
            line[0] = 1
            np.multiply.accumulate(line, out=line)
            _POWERS[name] = line
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and, last, the number of words)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    inside = np.concatenate(([False], ~WHITE[data]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edges[0::2], edges[1::2]
    up, down = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(LETTERS[data] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[last] - sums[first]) * down[first])
    return hashes, np.concatenate(([0], np.searchsorted(first, ends)))


def chunks(items: Iterable[tuple], size: int = CHUNK) -> Iterator[list[tuple]]:
    """Items whose last member is a text as bytes, in lists of at most about ``size`` bytes."""
    held, n = [], 0
    for item in items:
        held.append(item)
        n += len(item[-1])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held
