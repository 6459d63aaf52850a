"""Cover trees over unit vectors, and their dual traversal for all pairs within a distance.

Level i has the radius RADII[i], half of the one above. Its nodes are points that lie farther than this radius from
each other (separation); every point lies within it of a node (covering); the nodes of a level stay nodes on all levels
below (nesting). On the last level every point is a node. A point that first appears on a level is the child of the
nearest node one level up.

Points are numbered in depth-first order, so what lies below a node is a range of points, and the children of a node
are a range of the next level's nodes. A node's covering radius is the greatest distance to a point below it.

The traversal goes down two trees together. With centres at distance d and covering radii r and s, a pair of nodes has
no link if d > limit + r + s, and all its pairs of points are links if d + r + s <= limit; else the children's pairs
are looked at. Pairs of single points are decided by their cosine itself. Found links are not listed: a range of points
gains the other range's weight, and both ranges are merged into one group, so that a large group of near copies costs
ranges, not pairs.

Points without structure are nodes high up already, and going down with all pairs of them costs more than the pairs of
points below. Where tiles are not dearer than what the children's pairs cost, ranges of points are multiplied in tiles
instead, in single precision and over the first columns of a basis only: with heads g, h of two unit vectors and
lengths s, t of what is left of them, the cosine is at most gh + st, the product of the heads with the length as a
further column. Where this bound, less what rounding may do,
reaches the threshold, the cosine itself decides in double precision.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

RADII = [2.0 ** -k for k in range(-1, 7)]  # 2 covers every unit vector; the last is 1/64
BATCH = 256        # points that may become nodes together
ROOM = 1 << 21     # numbers held at once
HEAVY = 1 << 14    # children's pairs from which on a product of matrices is taken
DIRECT = 8         # pairs of points in tiles that cost as much as one pair of children in a product,
LISTED = 128       # as much as one that is listed,
CALL = 12000       # and as much as the call for a tile
SMALL = 1 << 12    # pairs of a tile that needs no care
TILE = 512         # points to a side of a tile; it stays in the cache
LINE = 512         # flags of a tile that are looked at together
CROWDED = 1 / 64   # share of a tile's pairs from which on all its cosines are taken
SLACK = 1e-6       # distances near zero are known to some 3e-8


def distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * cosine, 0.0))


def levels_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of unit vectors the level on which it first appears, and its parent one level above."""
    last = len(RADII)
    level, parent = np.full(len(x), last, np.int64), np.zeros(len(x), np.int64)
    level[0] = 0
    near, gap = np.zeros(len(x), np.int64), distance(x @ x[0])
    rest = np.arange(1, len(x))  # not yet nodes
    for i in range(1, last):
        above = near.copy()
        while True:
            batch = rest[gap[rest] > RADII[i]][:BATCH]
            if not len(batch):
                break
            apart = distance(x[batch] @ x[batch].T) > RADII[i]
            free, chosen = np.ones(len(batch), bool), []
            for k in range(len(batch)):
                if free[k]:
                    chosen.append(k)
                    free &= apart[k]
            chosen = batch[chosen]
            level[chosen], parent[chosen] = i, above[chosen]
            rest = rest[level[rest] == last]
            for start in range(0, len(rest), ROOM // BATCH):
                some = rest[start:start + ROOM // BATCH]
                cosine = x[some] @ x[chosen].T
                best = cosine.argmax(axis=1)
                d = distance(cosine[np.arange(len(some)), best])
                closer = d < gap[some]
                gap[some[closer]], near[some[closer]] = d[closer], chosen[best[closer]]
    parent[rest] = near[rest]
    return level, parent


def _ancestors(level: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """(level, point): the node above the point on that level."""
    up = np.empty((len(RADII) + 1, len(level)), np.int64)
    up[-1] = np.arange(len(level))
    for i in range(len(RADII) - 1, -1, -1):
        up[i] = np.where(level[up[i + 1]] <= i, up[i + 1], parent[up[i + 1]])
    return up


def depth_first(level: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The points in an order in which those below a node follow each other."""
    return np.lexsort(_ancestors(level, parent)[::-1])


@dataclass(frozen=True)
class Nodes:
    """The nodes of one level, in the order of their points."""
    centre: np.ndarray
    start: np.ndarray   # points below
    end: np.ndarray
    radius: np.ndarray
    first: np.ndarray   # children among the nodes of the next level
    past: np.ndarray


class Levels:
    """The nodes of a tree's levels, each made when it is first asked for."""

    def __init__(self, x: np.ndarray, level: np.ndarray, parent: np.ndarray):
        self.x, self.up = x, _ancestors(level, parent)
        self.made: dict[int, Nodes] = {}

    def __getitem__(self, i: int) -> Nodes:
        if i not in self.made:
            row, start = self.up[i], self._starts(i)
            end = np.append(start[1:], len(row))
            away = np.where(row == np.arange(len(row)), 0.0, distance(np.einsum("ij,ij->i", self.x, self.x[row])))
            children = self._starts(min(i + 1, len(self.up) - 1))
            self.made[i] = Nodes(row[start], start, end, np.maximum.reduceat(away, start),
                                 np.searchsorted(children, start), np.searchsorted(children, end))
        return self.made[i]

    def _starts(self, i: int) -> np.ndarray:
        return np.flatnonzero(np.diff(self.up[i], prepend=-1))


def heads(x: np.ndarray, basis: np.ndarray | None) -> np.ndarray:
    """Unit vectors in the columns of an orthonormal basis, and the length of what these leave; whole without one."""
    if basis is None:
        return x.astype(np.float32)
    head = x @ basis
    left = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", head, head)))
    return np.column_stack([head, left]).astype(np.float32)


class CoverTree:
    """A tree over unit vectors that are in depth-first order, with their levels, parents and weights. Trees that are
    gone down together have the same basis."""

    def __init__(self, x: np.ndarray, level: np.ndarray, parent: np.ndarray, weight: np.ndarray,
                 basis: np.ndarray | None = None):
        self.x, self.weight = x, weight
        self.total = np.concatenate([[0], np.cumsum(weight)])
        self.levels = Levels(x, level, parent)
        self.head = heads(x, basis)

    @classmethod
    def over(cls, x: np.ndarray, weight: np.ndarray) -> tuple[CoverTree, np.ndarray]:
        """The tree, and the rows of x in its order."""
        level, parent = levels_of(x)
        order = depth_first(level, parent)
        place = np.argsort(order)
        return cls(x[order], level[order], place[parent[order]], weight[order]), order


class Groups:
    """Points that belong together; each is labelled by the smallest of its group."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            one, two = self.label[a], self.label[b]
            unlike = one != two
            if not unlike.any():
                return
            a, b, one, two = a[unlike], b[unlike], one[unlike], two[unlike]
            np.minimum.at(self.label, np.maximum(one, two), np.minimum(one, two))
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]


class Tiles:
    """Products of a tile, in memory that is taken once."""

    def __init__(self):
        self.products = np.empty(0, np.float32)

    def reached(self, a: np.ndarray, b: np.ndarray, least: np.float32) -> np.ndarray:
        """The flat numbers of the pairs of rows whose product is `least` or more."""
        n = len(a) * len(b)
        if n <= SMALL:
            return np.flatnonzero(a @ b.T >= least)
        if not len(self.products):
            self.products, self.flags = np.empty(TILE * TILE, np.float32), np.empty(TILE * TILE + LINE, bool)
        np.matmul(a, b.T, out=self.products[:n].reshape(len(a), len(b)))
        np.greater_equal(self.products[:n], least, out=self.flags[:n])
        # Few are set, in few lines.
        lines = -(-n // LINE)
        self.flags[n:lines * LINE] = False
        flags = self.flags[:lines * LINE].reshape(lines, LINE)
        some = np.flatnonzero(flags.view(np.uint64).max(axis=1))
        line, flag = np.nonzero(flags[some])
        return some[line] * LINE + flag


class Traversal:
    """The links between two trees, or within one: `gain` per point of each tree (the weight of all points that it is
    linked with; within one tree itself included), and the groups that the links make."""

    def __init__(self, one: CoverTree, two: CoverTree, cosine: float):
        self.one, self.two, self.cosine = one, two, cosine
        self.limit = float(np.sqrt(2.0 - 2.0 * cosine))
        self.within = one is two
        self.looked_at = 0
        self.offset = 0 if self.within else len(one.x)
        size = self.offset + len(two.x)
        # Rounding of both factors and of every sum of products that add up to 1 at most.
        self.bound = np.float32(cosine - (one.head.shape[1] + 8) * 2.0 ** -23)
        self._direct = np.zeros(size, np.int64)   # of single points
        self._tiles = Tiles()
        self._gain = np.zeros(size + 1, np.int64)
        self._run = np.zeros(size + 1, np.int64)  # over 0 where a point belongs with the next
        self.groups = Groups(size)
        self._walk()
        self.gain = np.cumsum(self._gain)[:-1] + self._direct
        runs = np.flatnonzero(np.cumsum(self._run)[:-1] > 0)
        self.groups.join(runs, runs + 1)

    def _walk(self) -> None:
        top = np.zeros(1, np.int64)
        first = self._judged(0, top, top, np.array([self.one.x[0] @ self.two.x[0]]))
        # One portion per level is held at a time, however many pairs of nodes a level has.
        stack = [iter([first])]
        while stack:
            pairs = next(stack[-1], None)
            if pairs is None:
                stack.pop()
            elif len(pairs[0]):
                stack.append(self._children(len(stack) - 1, *pairs))

    def _judged(self, level: int, p: np.ndarray, q: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Settles the pairs of nodes that can be settled and gives the others."""
        self.looked_at += len(p)
        a, b = self.one.levels[level], self.two.levels[level]
        single = (a.end[p] - a.start[p] == 1) & (b.end[q] - b.start[q] == 1)
        far, reach = distance(cosine), a.radius[p] + b.radius[q]
        linked = np.where(single, cosine >= self.cosine, far + reach + SLACK <= self.limit)
        # Distances to itself are exactly zero.
        if self.within:
            linked |= (p == q) & single
        self._link(a, b, p[linked], q[linked])
        on = ~linked & ~single & (far <= self.limit + reach + SLACK)
        return p[on], q[on]

    def _link(self, a: Nodes, b: Nodes, p: np.ndarray, q: np.ndarray) -> None:
        s, e, u, v = a.start[p], a.end[p], b.start[q], b.end[q]
        self._add(s, e, self.two.total[v] - self.two.total[u])
        other = np.ones(len(p), bool) if not self.within else p != q
        gained = (self.one.total[e] - self.one.total[s])[other]
        u, v = u + self.offset, v + self.offset
        self._add(u[other], v[other], gained)
        for start, end in ((s, e), (u, v)):
            np.add.at(self._run, start, 1)
            np.add.at(self._run, end - 1, -1)
        self.groups.join(s, u)

    def _add(self, start: np.ndarray, end: np.ndarray, weight: np.ndarray) -> None:
        np.add.at(self._gain, start, weight)
        np.add.at(self._gain, end, -weight)

    def _children(self, level: int, p: np.ndarray, q: np.ndarray):
        """Pairs of children that are not settled, in portions."""
        a, b = self.one.levels[level], self.two.levels[level]
        many = (a.past[p] - a.first[p]) * (b.past[q] - b.first[q])
        points = (a.end[p] - a.start[p]) * (b.end[q] - b.start[q])
        direct = points + CALL <= np.where(many > HEAVY, DIRECT, LISTED) * many
        for k in np.flatnonzero(direct):
            self._points(a.start[p[k]], a.end[p[k]], b.start[q[k]], b.end[q[k]], self.within and p[k] == q[k])
        p, q, many = p[~direct], q[~direct], many[~direct]
        for k in np.flatnonzero(many > HEAVY):
            yield from self._product(level + 1, a.first[p[k]], a.past[p[k]], b.first[q[k]], b.past[q[k]],
                                     self.within and p[k] == q[k])
        light = np.flatnonzero(many <= HEAVY)
        if not len(light):
            return
        room = max(HEAVY, ROOM // self.one.x.shape[1])
        portion = np.cumsum(many[light]) // room
        for part in np.split(light, np.flatnonzero(np.diff(portion)) + 1):
            yield self._listed(level + 1, p[part], q[part], many[part])

    def _points(self, start: int, end: int, other: int, past: int, same: bool) -> None:
        """Links between two ranges of points, or within one."""
        if same:
            self._direct[start:end] += self.one.weight[start:end]
        for i in range(start, end, TILE):
            for j in range(i if same else other, past, TILE):
                self._tile(slice(i, min(i + TILE, end)), slice(j, min(j + TILE, past)), same and i == j)

    def _tile(self, rows: slice, columns: slice, diagonal: bool) -> None:
        self.looked_at += (rows.stop - rows.start) * (columns.stop - columns.start)
        found = self._tiles.reached(self.one.head[rows], self.two.head[columns], self.bound)
        if not len(found):
            return
        across = columns.stop - columns.start
        beside = slice(columns.start + self.offset, columns.stop + self.offset)
        if len(found) > CROWDED * (rows.stop - rows.start) * across:
            linked = self.one.x[rows] @ self.two.x[columns].T >= self.cosine
            if diagonal:
                linked &= np.tri(*linked.shape, dtype=bool).T
                np.fill_diagonal(linked, False)
            counted = linked.astype(np.float64)
            self._direct[rows] += (counted @ self.two.weight[columns]).astype(np.int64)
            self._direct[beside] += (self.one.weight[rows] @ counted).astype(np.int64)
            linked &= self.groups.label[rows][:, None] != self.groups.label[beside]
            p, q = np.nonzero(linked)
            self.groups.join(p + rows.start, q + beside.start)
            return
        p, q = np.divmod(found, across)
        p, q = p + rows.start, q + columns.start
        linked = np.einsum("ij,ij->i", self.one.x[p], self.two.x[q]) >= self.cosine
        if diagonal:
            linked &= p < q
        p, q = p[linked], q[linked]
        np.add.at(self._direct, p, self.two.weight[q])
        np.add.at(self._direct, q + self.offset, self.one.weight[p])
        self.groups.join(p, q + self.offset)

    def _listed(self, level: int, p: np.ndarray, q: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        above, beside = self.one.levels[level - 1], self.two.levels[level - 1]
        k = np.repeat(np.arange(len(p)), many)
        nth = np.arange(len(k)) - np.repeat(np.cumsum(many) - many, many)
        wide = (beside.past[q] - beside.first[q])[k]
        c, d = above.first[p][k] + nth // wide, beside.first[q][k] + nth % wide
        if self.within:  # of a node with itself every pair of children once
            once = (p != q)[k] | (c <= d)
            c, d = c[once], d[once]
        cosine = np.einsum("ij,ij->i", self.one.x[self.one.levels[level].centre[c]],
                           self.two.x[self.two.levels[level].centre[d]])
        return self._judged(level, c, d, cosine)

    def _product(self, level: int, first: int, past: int, other: int, end: int, same: bool):
        a, b = self.one.levels[level], self.two.levels[level]
        right = self.two.x[b.centre[other:end]].T
        step = max(1, ROOM // (end - other))
        for start in range(first, past, step):
            rows = np.arange(start, min(start + step, past))
            skip = start - first if same else 0
            cosine = self.one.x[a.centre[rows]] @ right[:, skip:]
            reach = np.minimum((self.limit + a.radius[rows] + SLACK)[:, None] + b.radius[other + skip:end], 2.0)
            i, j = np.nonzero(cosine >= 1.0 - reach * reach / 2.0 - 1e-12)
            s, e, u, v = a.start[rows[0]], a.end[rows[-1]], b.start[other + skip], b.end[end - 1]
            if (e - s) * (v - u) + CALL <= LISTED * len(i):
                if same:
                    self._points(s, e, s, e, True)
                    u = e
                self._points(s, e, u, v, False)
                continue
            self.looked_at += cosine.size - len(i)
            c, d = rows[i], other + skip + j
            if same:
                keep = c <= d
                i, j, c, d = i[keep], j[keep], c[keep], d[keep]
            for portion in range(0, len(c), HEAVY):
                part = slice(portion, portion + HEAVY)
                yield self._judged(level, c[part], d[part], cosine[i[part], j[part]])
