"""Growing and walking regression trees with numpy, inside tasks.

Rows are given by their bins, a whole-number label and a weight. All sums are whole numbers below 2 ** 53, so that they
are exact in any order, and what is drawn hangs on hashes of the seed, the tree and the row or node only. A tree is four
arrays: of each node the feature (-1: a leaf), the last bin that goes left, and the place of the left child, which the
right one follows; of a leaf that place is -1 - k, where k is its place among the leaves' values.
"""

from __future__ import annotations

import numpy as np

MOST_MEAN = 256   # larger means of a Poisson draw are drawn in parts
LEAST_SHARE = 1e-12
_TREE, _NODE, _PART = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _of_tree(seed: int, tree: int) -> np.ndarray:
    return mixed(np.array([seed % 2**64], np.uint64) + _TREE * np.array([tree + 1], np.uint64))


def bagged(hashes: np.ndarray, counts: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each of the rows, which stand for `counts` equal ones, is in the bag of this tree: Poisson draws."""
    weights, left, part = np.zeros(len(hashes), np.int64), counts.astype(np.int64).copy(), 0
    base = hashes.view(np.uint64) + _of_tree(seed, tree)
    todo = np.arange(len(hashes))
    while len(todo):
        mean = np.minimum(left[todo], MOST_MEAN).astype(np.float64)
        drawn = (mixed(base[todo] + _PART * np.array([part], np.uint64)) >> np.uint64(11)).astype(np.float64) / 2.0**53
        chance = np.exp(-mean)
        reached, at, k = chance.copy(), np.flatnonzero(drawn >= chance), 0
        while len(at) and k < 4 * MOST_MEAN:
            k += 1
            weights[todo[at]] += 1
            chance[at] *= mean[at] / k
            reached[at] += chance[at]
            at = at[drawn[at] >= reached[at]]
        left[todo] -= MOST_MEAN
        todo, part = todo[left[todo] > 0], part + 1
    return weights


def drawn_features(paths: np.ndarray, width: int, most: int, seed: int, tree: np.ndarray) -> np.ndarray:
    """Per node, named by its path (1 is the root, 2k and 2k + 1 the children of k), `most` features, ascending."""
    base = mixed(np.array([seed % 2**64], np.uint64) + _TREE * (tree.astype(np.uint64) + np.uint64(1)))
    order = mixed(mixed(base + _NODE * paths.astype(np.uint64))[:, None] + _PART * np.arange(1, width + 1, dtype=np.uint64))
    return np.sort(np.argsort(order, axis=1, kind="stable")[:, :most], axis=1)


def best_cuts(node: np.ndarray, bin_: np.ndarray, weight: np.ndarray, total: np.ndarray, nodes: int):
    """The best cut of every node by one feature, from sums by node and bin (ascending): gain (-1: none) and bin.

    The gain is what the sums of squares within the sides fall short of the node's. Of equal gains the first bin."""
    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(node)]]))
    w, s = np.cumsum(weight), np.cumsum(total)
    before_w, before_s = w[starts] - weight[starts], s[starts] - total[starts]
    all_w, all_s = np.repeat(np.add.reduceat(weight, starts), sizes), np.repeat(np.add.reduceat(total, starts), sizes)
    left_w, left_s = w - np.repeat(before_w, sizes), s - np.repeat(before_s, sizes)
    right_w, right_s = all_w - left_w, all_s - left_s
    sides = left_s * 1.0 * left_s / left_w + right_s * 1.0 * right_s / np.maximum(right_w, 1)
    gain = sides - all_s * 1.0 * all_s / all_w
    gain = np.where((right_w > 0) & (gain > LEAST_SHARE * sides), gain, -1.0)
    most = np.maximum.reduceat(gain, starts)
    first = np.flatnonzero(gain == np.repeat(most, sizes))
    first = first[np.unique(node[first], return_index=True)[1]]
    gains, bins = np.full(nodes, -1.0), np.zeros(nodes, np.int64)
    gains[node[starts]], bins[node[starts]] = most, bin_[first]
    return gains, bins


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys, ascending, and the sums of the values by them."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[starts], *(np.add.reduceat(v[order], starts) for v in values)


def grown(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, path: int, levels: int, most: int, seed: int,
          tree: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The tree under the node `path`, level by level; the values of leaves are in whole numbers."""
    features, lasts, lefts, values, held = [], [], [], [], 0
    node, paths, made = np.zeros(len(label), np.int64), np.array([path], np.int64), 1
    total = label * weight
    for level in range(levels + 1):
        count = len(paths)
        best, feature, last = np.full(count, -1.0), np.full(count, -1), np.zeros(count, np.int64)
        w, s = np.bincount(node, weight, count), np.bincount(node, total, count)
        if level < levels:
            drawn = drawn_features(paths, bins.shape[1], most, seed, np.full(count, tree))
            for k in range(drawn.shape[1]):
                at = bins[np.arange(len(node)), drawn[node, k]]
                key, weights, totals = summed(node * 256 + at, weight, total)
                gains, cut = best_cuts(key >> 8, key & 255, weights, totals, count)
                better = gains > best
                best[better], feature[better], last[better] = gains[better], drawn[better, k], cut[better]
        split = best > 0
        left = np.empty(count, np.int64)
        left[split] = made + 2 * np.arange(split.sum())
        left[~split] = -1 - held - np.arange((~split).sum())
        values.append(s[~split] / w[~split])
        features.append(np.where(split, feature, -1)), lasts.append(last), lefts.append(left)
        held, made = held + len(values[-1]), made + 2 * int(split.sum())
        if not split.any():
            break
        goes = split[node]
        node, bins, label, weight, total = node[goes], bins[goes], label[goes], weight[goes], total[goes]
        right = bins[np.arange(len(node)), feature[node]] > last[node]
        place = np.cumsum(split) - 1
        node = 2 * place[node] + right
        paths = (2 * paths[split][:, None] + np.array([0, 1])).reshape(-1)
    return (np.concatenate(features).astype(np.int8), np.concatenate(lasts).astype(np.uint8),
            np.concatenate(lefts).astype(np.int32), np.concatenate(values))


def reached(bins: np.ndarray, feature: np.ndarray, last: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The node without children that each row ends in."""
    node, width = np.zeros(len(bins), np.int64), bins.shape[1]
    flat = np.ascontiguousarray(bins).reshape(-1)
    going = np.flatnonzero(left[node] >= 0)
    while len(going):
        at = node[going]
        at = left[at] + (flat[going * width + feature[at]] > last[at])
        node[going] = at
        going = going[left[at] >= 0]
    return node


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Per feature the number of cuts below the value; a NaN is in the last bin."""
    bins = np.empty((len(x), len(cuts)), np.uint8)
    for f, at in enumerate(cuts):
        bins[:, f] = np.where(np.isnan(x[:, f]), len(at), np.searchsorted(at, x[:, f], "left"))
    return bins


def rounded(values: np.ndarray) -> np.ndarray:
    """The nearest whole numbers, halves away from zero."""
    return np.trunc(values + np.copysign(0.5, values)).astype(np.int64)


def place_in_full(bins: np.ndarray, feature: np.ndarray, last: np.ndarray, depth: int) -> np.ndarray:
    """Where rows end in a tree whose node k has the children 2k and 2k + 1; nodes without children have feature -1."""
    node, row = np.ones(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        at = feature[node]
        node = np.where(at < 0, node, 2 * node + (bins[row, np.maximum(at, 0)] > last[node]))
    return node
