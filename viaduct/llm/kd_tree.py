"""K-d trees over letter-count vectors, with range searches by L1 distance, and the check of the letters' order.

One inserted or deleted letter changes the counts by 1, a replaced one by 2, so words that differ by one edit lie within
that distance. A node has a box; its distance from a query is what the query's counts exceed the box by. Searches go
down for all queries together and leave out the nodes whose box is too far.

Fixed values: letters are a-z and the code points U+00C0 to U+00FF; words are held as one byte a letter (Latin-1).
"""

from __future__ import annotations

import numpy as np

LETTERS = 26 + 64
LEAF = 16
ROOM = 1 << 21  # numbers held at once

_PLACE = np.zeros(256, np.int64)
_PLACE[ord("a"):ord("z") + 1] = np.arange(26)
_PLACE[0xC0:] = np.arange(26, LETTERS)


def letter_counts(words: list[bytes]) -> np.ndarray:
    """(word, letter) -> how often."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    places = _PLACE[np.frombuffer(b"".join(words), np.uint8)]
    kind = np.int8 if sizes.max(initial=0) < 64 else np.int32
    counts = np.empty((len(words), LETTERS), kind)
    step = max(1, ROOM // LETTERS)
    ends = np.cumsum(sizes)
    for start in range(0, len(words), step):
        some = sizes[start:start + step]
        rows = np.repeat(np.arange(len(some)), some)
        letters = places[ends[start] - sizes[start]:ends[start + len(some) - 1]]
        counts[start:start + step] = np.bincount(
            rows * LETTERS + letters, minlength=len(some) * LETTERS).reshape(-1, LETTERS)
    return counts


class KdTree:
    """A tree over count vectors. With `regions`, boxes are the whole regions that the splits make, so that the tree can
    place vectors that it was not built from; otherwise they are as tight as its points."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, regions: bool = False):
        self.points, self.leaf, self.regions = points, leaf, regions
        self.order = np.arange(len(points))
        self.split, self.at, self.left, self.right = [], [], [], []
        self.low, self.high, self.start, self.end = [], [], [], []
        self.cell = []  # number among the leaves, or -1
        self.leaves = 0
        most = np.iinfo(points.dtype).max
        self._grow(np.zeros(points.shape[1], points.dtype), np.full(points.shape[1], most, points.dtype))
        self.low, self.high = np.stack(self.low), np.stack(self.high)
        self.split, self.at, self.left, self.right, self.start, self.end, self.cell = (
            np.array(c, np.int64) for c in (self.split, self.at, self.left, self.right, self.start, self.end, self.cell))

    def _grow(self, low: np.ndarray, high: np.ndarray) -> None:
        # A list of what is still to do rather than recursion: a tree may be as deep as it has points.
        todo = [(0, len(self.points), low, high, None)]
        while todo:
            start, end, low, high, above = todo.pop()
            node = len(self.split)
            if above is not None:
                (self.left if above[1] else self.right)[above[0]] = node
            mine = self.points[self.order[start:end]]
            least, most = (mine.min(axis=0), mine.max(axis=0)) if len(mine) else (low, high)
            self.low.append(low if self.regions else least)
            self.high.append(high if self.regions else most)
            self.start.append(start)
            self.end.append(end)
            letter, at = -1, 0
            if len(mine) > self.leaf and (most > least).any():
                letter = int(mine.var(axis=0, dtype=np.float64).argmax())
                values = mine[:, letter]
                at = int(np.median(values))
                if at >= most[letter]:
                    at = int(most[letter]) - 1
            self.split.append(letter)
            self.at.append(at)
            self.left.append(-1)
            self.right.append(-1)
            self.cell.append(-1 if letter >= 0 else self.leaves)
            if letter < 0:
                self.leaves += 1
                continue
            below = values <= at
            rows = self.order[start:end]
            self.order[start:end] = np.concatenate([rows[below], rows[~below]])
            middle = start + int(below.sum())
            under, over = high.copy(), low.copy()
            under[letter], over[letter] = at, at + 1
            todo.append((middle, end, over, high, (node, False)))
            todo.append((start, middle, low, under, (node, True)))

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf whose region holds each point."""
        node = np.zeros(len(points), np.int64)
        while True:
            inner = np.flatnonzero(self.split[node] >= 0)
            if not len(inner):
                return self.cell[node]
            at = node[inner]
            node[inner] = np.where(points[inner, self.split[at]] <= self.at[at], self.left[at], self.right[at])

    def reached(self, queries: np.ndarray, distance: int):
        """(query, node) arrays of the leaves whose boxes lie within the distance, in portions."""
        wide = max(1, ROOM // queries.shape[1])
        todo = [(np.arange(start, min(start + wide, len(queries))), None) for start in range(0, len(queries), wide)]
        while todo:
            query, node = todo.pop()
            node = np.zeros(len(query), np.int64) if node is None else node
            points = queries[query].astype(np.int32)
            # A count is outside of the box on one side at most.
            off = np.maximum(np.maximum(self.low[node] - points, points - self.high[node]), 0).sum(axis=1)
            near = off <= distance
            query, node = query[near], node[near]
            leaf = self.split[node] < 0
            if leaf.any():
                yield query[leaf], node[leaf]
            query, node = query[~leaf], node[~leaf]
            if len(query):
                both = np.concatenate([query, query]), np.concatenate([self.left[node], self.right[node]])
                for start in range(0, len(both[0]), wide):
                    todo.append((both[0][start:start + wide], both[1][start:start + wide]))

    def within(self, queries: np.ndarray, distance: int):
        """(query, point) arrays of all pairs at exactly this distance, in portions."""
        wide = max(1, ROOM // queries.shape[1])
        for query, node in self.reached(queries, distance):
            many = self.end[node] - self.start[node]
            ends = np.cumsum(many)
            for start in range(0, int(ends[-1]), wide):
                nth = np.arange(start, min(start + wide, int(ends[-1])))
                k = np.searchsorted(ends, nth, side="right")
                point = self.order[self.start[node[k]] + nth - (ends[k] - many[k])]
                q = query[k]
                off = np.abs(queries[q] - self.points[point]).sum(axis=1, dtype=np.int32)
                hit = off == distance
                yield q[hit], point[hit]


def _letters(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def one_replaced(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Which pairs of words of one length differ in exactly one letter."""
    return (_letters(a) != _letters(b)).sum(axis=1) == 1


def one_inserted(short: list[bytes], long: list[bytes]) -> np.ndarray:
    """Which of the longer words, by one letter, hold the shorter one with one letter put in."""
    one, two = _letters(short), _letters(long)
    front = np.logical_and.accumulate(one == two[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((one == two[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= one.shape[1]
