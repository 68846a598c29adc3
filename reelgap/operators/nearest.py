"""Nearest names by edit distance: two tries walked together, so that names which share a beginning share the work.

A cell stands for a beginning of a left name and one of a right name, with the distance of the two. From a cell, only
beginnings one character longer are reached, and only where the distance can still end within what is allowed. Names
are of ASCII characters, and all names of a trie have one length, which fixes what is still needed at least.

Names that share little make more cells than pairs; what is left of a walk then goes by whole tables of distances, in
batches of pairs side by side.
"""

from __future__ import annotations

import numpy as np

#: So many cells are opened at once at most, unless they belong to one beginning of a left name.
CELLS = 1 << 21
#: Walks are given up before they open more cells than this share of the pairs, and more than LEAST.
SHARE, LEAST = 0.1, 1 << 17
#: Pairs in a whole table.
BATCH = 1 << 15


class Trie:
    """Different names of one length (dtype S, in order), as arrays of nodes by depth; the nodes of the last depth are the names."""

    def __init__(self, names: np.ndarray, length: int) -> None:
        self.names, self.length = names, length
        letters = np.frombuffer(names.tobytes(), np.uint8).reshape(len(names), length) if length else np.zeros((len(names), 0), np.uint8)
        self.counts, self.first, self.letter, self.keys = [min(len(names), 1)], [], [None], [None]
        new = np.zeros(len(names), bool)
        new[:1] = True
        above = np.zeros(len(names), np.int64)
        for depth in range(length):
            new[1:] |= letters[1:, depth] != letters[:-1, depth]
            rows = np.flatnonzero(new)
            parents = above[rows]
            self.letter.append(letters[rows, depth])
            self.keys.append(parents << 8 | self.letter[-1])
            self.first.append(np.searchsorted(parents, np.arange(self.counts[-1] + 1)))
            self.counts.append(len(rows))
            above = np.cumsum(new) - 1

    def children(self, depth: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of nodes of a depth, and which of ``nodes`` each belongs to."""
        low, n = self.first[depth][nodes], self.first[depth][nodes + 1] - self.first[depth][nodes]
        owner = np.repeat(np.arange(len(nodes)), n)
        return np.arange(len(owner)) - np.repeat(np.cumsum(n) - n - low, n), owner

    def child(self, depth: int, nodes: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The child by a letter, for those of ``nodes`` that have it, and which these are."""
        keys, wanted = self.keys[depth + 1], nodes << 8 | letters
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        owner = np.flatnonzero(keys[at] == wanted)
        return at[owner], owner


def _smallest(u: list[np.ndarray], v: list[np.ndarray], d: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different cells with their smallest distance, in order of u."""
    codes = (np.concatenate(u) * width + np.concatenate(v)) << 16 | np.concatenate(d)
    codes.sort()
    cells = codes >> 16
    fresh = np.ones(len(cells), bool)
    fresh[1:] = cells[1:] != cells[:-1]
    cells = cells[fresh]
    return cells // width, cells % width, codes[fresh] & 65535


def _step(left: Trie, right: Trie, at: int, cells: dict, most: int, lengths: tuple[int, int]) -> dict:
    """Cells of the left depth ``at + 1`` from those of ``at``."""
    m, n = lengths
    opened = {}
    for depth, (u, v, d) in cells.items():
        w, owner = left.children(at, u)
        opened[depth] = w, v[owner], d[owner]
    found: dict = {}
    for depth in range(n + 1):
        allowed = most - abs((m - at - 1) - (n - depth))
        parts: list[tuple] = []
        if allowed < 0:
            continue
        if depth in opened:  # the left letter is left out
            u, v, d = opened[depth]
            keep = d < allowed
            parts.append((u[keep], v[keep], d[keep] + 1))
        if depth - 1 in opened:  # letters stand against each other
            u, v, d = opened[depth - 1]
            letters = left.letter[at + 1][u]
            keep = d < allowed
            w, owner = right.children(depth - 1, v[keep])
            parts.append((u[keep][owner], w, d[keep][owner] + (letters[keep][owner] != right.letter[depth][w])))
            keep = d == allowed
            w, owner = right.child(depth - 1, v[keep], letters[keep])
            parts.append((u[keep][owner], w, d[keep][owner]))
        if depth - 1 in found:  # a right letter is added
            u, v, d = found[depth - 1]
            keep = d < allowed
            w, owner = right.children(depth - 1, v[keep])
            parts.append((u[keep][owner], w, d[keep][owner] + 1))
        if sum(len(p[0]) for p in parts):
            found[depth] = _smallest(*(list(x) for x in zip(*parts)), right.counts[depth])
    return found


def _pairs(left: Trie, right: Trie, most: int, lengths: tuple[int, int], budget: list, done: np.ndarray):
    """(left names, right names) of all pairs at most ``most`` apart, all right names of a left name together.

    ``budget`` has the number of cells that may be opened yet. ``done`` gets the left names that were compared: all,
    unless the walk is given up.
    """
    m, n = lengths
    last, start = [np.arange(c + 1) for c in left.counts], {}
    for depth in range(m - 1, -1, -1):
        last[depth] = last[depth + 1][left.first[depth]]
    done[:] = True
    for depth in range(n + 1):
        if depth <= most - abs(m - (n - depth)):
            v = np.arange(right.counts[depth])
            start[depth] = np.zeros(len(v), np.int64), v, np.full(len(v), depth)
    todo = [(0, start)]
    while todo:
        at, cells = todo.pop()
        if at == m:
            if n in cells:
                yield cells[n][:2]
            continue
        work = lambda depth, u, v: (left.first[at][u + 1] - left.first[at][u]) * (1 + (right.first[depth][v + 1] - right.first[depth][v] if depth < n else 0))
        low, high = min(int(u[0]) for u, _, _ in cells.values()), max(int(u[-1]) for u, _, _ in cells.values())
        opening = sum(int(work(depth, u, v).sum()) for depth, (u, v, _) in cells.items())
        if budget[0] < 0:
            done[last[at][low] : last[at][high + 1]] = False
            continue
        if low < high and opening > CELLS:
            middle = (low + high + 1) // 2
            for part in (slice(middle, None), slice(None, middle)):
                share = {}
                for depth, (u, v, d) in cells.items():
                    cut = int(np.searchsorted(u, middle))
                    rows = slice(cut, None) if part.start else slice(None, cut)
                    if len(u[rows]):
                        share[depth] = u[rows], v[rows], d[rows]
                todo.append((at, share))
            continue
        budget[0] -= opening
        if budget[0] < 0:
            done[last[at][low] : last[at][high + 1]] = False
            continue
        cells = _step(left, right, at, cells, most, lengths)
        if cells:
            todo.append((at + 1, cells))


def _dense(left: np.ndarray, right: np.ndarray, places: np.ndarray, most: int, lengths: tuple[int, int]):
    """(left names, right names) where the smallest distance is ``most`` at most; the right name that is first by ``places``."""
    m, n = lengths
    table = lambda names, size: np.frombuffer(names.tobytes(), np.uint8).reshape(len(names), size).T if size else None
    known = np.ascontiguousarray(table(right, n)) if n else None
    far = most + 1
    kind = np.uint8 if far + m + n < 250 else np.int32
    step = max(1, BATCH // len(right))
    for first in range(0, len(left), step):
        some = left[first : first + step]
        shape, coming = (len(some), len(right)), table(some, m)
        row = [np.full(shape, min(j, far), kind) for j in range(n + 1)]
        for i in range(1, m + 1):
            # outside this band no distance can end within ``most``
            low, high = max(0, i - (m - n + most) // 2 - 1), min(n, i + (n - m + most) // 2 + 1)
            now = [None] * (n + 1)
            for j in range(low, high + 1):
                cell = row[j] + kind(1) if row[j] is not None else np.full(shape, far, kind)
                if j and now[j - 1] is not None:
                    np.minimum(cell, now[j - 1] + kind(1), out=cell)
                if j and row[j - 1] is not None:
                    np.minimum(cell, row[j - 1] + (coming[i - 1][:, None] != known[j - 1]), out=cell)
                now[j] = cell
            row = now
        best = row[n].min(axis=1)
        near = np.flatnonzero(best <= most)
        if len(near):
            yield first + near, np.where(row[n][near] == best[near, None], places, len(places)).argmin(axis=1)


def nearest(left: Trie, right: Trie, ranks: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of left names and of their nearest right names, up to ``most`` edits; among equally near ones that of the smallest rank.

    More edits are tried only for names that fewer didn't match.
    """
    lengths, rest = (left.length, right.length), np.arange(len(left.names))
    by_rank = np.argsort(ranks)
    places = np.empty(len(by_rank), np.int64)
    places[by_rank] = np.arange(len(by_rank))
    found, matched = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    trie, budget = left, [max(LEAST, SHARE * len(left.names) * len(right.names))]
    for k in range(abs(lengths[0] - lengths[1]), most + 1):
        hit, done = np.zeros(len(rest), bool), np.zeros(len(rest), bool)
        for u, v in _pairs(trie, right, k, lengths, budget, done):
            starts = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
            found.append(rest[u[starts]])
            matched.append(by_rank[np.minimum.reduceat(places[v], starts)])
            hit[u[starts]] = True
        rest = rest[~hit]
        if not done.all():
            for u, v in _dense(left.names[rest], right.names, places, most, lengths):
                found.append(rest[u])
                matched.append(v)
            break
        if not len(rest):
            break
        if hit.any():
            trie = Trie(left.names[rest], lengths[0])
    return np.concatenate(found), np.concatenate(matched)
