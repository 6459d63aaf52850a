"""Second-order boosting with an L1 term and columns drawn per tree, by histograms that Spark aggregates.

Spark's own boosted trees have neither. Each tree sees a seeded draw of the features. A level of a tree costs one
aggregate: the sum and number of the gradients per node, feature and bin, at most nodes * features * BINS rows, which is
all that reaches the driver. Where the drawn features have few bins, at most CELLS combinations, the sums per
combination hold the histograms of all nodes, and a whole tree costs one aggregate. Leaf weights are soft-thresholded: -T(G) / (H + l2), where T takes `alpha` off the sum of
the gradients' magnitude, and a split must gain by the sums of T(G)^2 / (H + l2). The loss is the squared error.

Gradients are summed as whole numbers of a fixed fraction, so that a fit does not depend on how the rows are
partitioned. Rows are stored in the shared folder as blocks of bins, labels and predictions, and again with new
predictions after every few trees, so that a lost executor brings no early tree back. Tasks sum a block with numpy;
Spark adds up the sums of the blocks.
"""

from __future__ import annotations

import json
import random
from itertools import chain
from math import floor, inf, log2, prod

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from ..session import shared_dir
from ..shipping import ship
from . import growing

BINS = 256
TREES_PER_STORE = 8
ROWS_PER_BLOCK = 1 << 16
LEAST_GAIN = 1e-6
CELLS = 1 << 17
BATCH_ROWS = 4096  # rows that go down the trees together, so that their features stay in the CPU's cache
WHOLE_BITS = 52   # a sum of gradients stays below 2 ** WHOLE_BITS


def soft_threshold(gradient: float, alpha: float) -> float:
    return gradient - alpha if gradient > alpha else gradient + alpha if gradient < -alpha else 0.0


def cut_points(rows: DataFrame, width: int, bins: int = BINS) -> list[list[float]]:
    """Per feature of the array `x` the ascending values to cut at: all values but the greatest if there are at most
    `bins`, else quantiles. A value lies in the bin of the first cut that is not below it."""
    each = rows.select(F.posexplode("x").alias("feature", "value")).where("NOT isnan(value)")
    found = {row["feature"]: row for row in each.groupBy("feature").agg(
        F.approx_count_distinct("value", 0.02).alias("distinct"),
        F.percentile_approx("value", [k / bins for k in range(1, bins)], 20 * bins).alias("quantiles"),
        F.max("value").alias("most")).collect()}
    few = [f for f, row in found.items() if row["distinct"] <= bins]
    cuts: list[list[float]] = [[] for _ in range(width)]
    if few:
        for row in each.where(F.col("feature").isin(few)).distinct().orderBy("feature", "value").collect():
            cuts[row["feature"]].append(row["value"])
    for feature, row in found.items():
        if feature not in few:
            cuts[feature] = sorted(set(row["quantiles"]) | {row["most"]})
    return [values[:-1] for values in cuts]


class Tree:
    """A binary tree whose node k has the children 2k and 2k + 1; `splits` holds (feature, bin), rows up to the bin go
    left; `weights` the values of the leaves."""

    def __init__(self):
        self.splits: dict[int, tuple[int, int]] = {}
        self.weights: dict[int, float] = {}

    def full(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature (-1: no split), bin and value of every node of a full tree."""
        size = 2 ** (depth + 1)
        feature, last, weight = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
        for node, split in self.splits.items():
            feature[node], last[node] = split
        for node, value in self.weights.items():
            weight[node] = value
        return feature, last, weight


def best_split(histogram: dict[int, list[tuple[int, float, int]]], alpha: float, l2: float,
               least_rows: float) -> tuple[float, int, int, tuple[float, int], tuple[float, int]] | None:
    """The best (gain, feature, bin, left, right) of a node; the sides are (gradient, rows). `histogram` holds
    (bin, gradient, rows) per feature. Of equal gains the first feature and bin."""
    def worth(gradient: float, rows: int) -> float:
        return soft_threshold(gradient, alpha) ** 2 / (rows + l2)

    best = None
    for feature in sorted(histogram):
        parts = sorted(histogram[feature])
        gradient, rows = sum(g for _, g, _ in parts), sum(n for _, _, n in parts)
        g = n = 0
        for last, part, count in parts[:-1]:
            g, n = g + part, n + count
            if n < least_rows or rows - n < least_rows:
                continue
            gain = worth(g, n) + worth(gradient - g, rows - n) - worth(gradient, rows)
            if gain > LEAST_GAIN and (best is None or gain > best[0]):
                best = gain, feature, last, (g, n), (gradient - g, rows - n)
    return best


class _Blocks:
    """The rows, ROWS_PER_BLOCK to a stored row: b (a byte per feature), y and p (the prediction) as bytes."""

    def __init__(self, rows: DataFrame, cuts: list[list[float]], base: float, depth: int):
        edges = [np.array(at, np.float64) for at in cuts]

        def pack(batches):
            for x, y in _gathered(batches, len(edges)):
                yield _block(growing.binned(x, edges), y, np.full(len(y), base))

        self.width, self.depth, self.pending = len(cuts), depth, []
        self.data = rows.mapInArrow(pack, "b binary, y binary, p binary").checkpoint()

    def grow(self, tree: Tree) -> None:
        """Add what the tree gives to the predictions."""
        self.pending.append(tree.full(self.depth))
        if len(self.pending) == TREES_PER_STORE:
            open_ = self._open()

            def run(batches):
                for block in open_(batches):
                    yield _block(*block)

            self.data, self.pending = self.data.mapInArrow(run, "b binary, y binary, p binary").checkpoint(), []

    def _open(self):
        width, depth, pending = self.width, self.depth, self.pending

        def blocks(batches):
            for batch in batches:
                for b, y, p in zip(*(batch.column(c).to_pylist() for c in ("b", "y", "p"))):
                    bins, p = np.frombuffer(b, np.uint8).reshape(-1, width), np.frombuffer(p)
                    for feature, last, weight in pending:
                        p = p + weight[growing.place_in_full(bins, feature, last, depth)]
                    yield bins, np.frombuffer(y), p
        return blocks

    def sums(self, scale: float, keys) -> pa.Table:
        """(part, key, g, n): sums of the gradients in whole numbers and numbers of rows. `keys` gives, for bins, triples
        of a part, the keys of the rows (-1: none) and the number of keys."""
        open_ = self._open()

        def run(batches):
            for bins, y, p in open_(batches):
                g = growing.rounded((p - y) * scale)
                for part, key, size in keys(bins):
                    key = key + 1
                    n = np.bincount(key, minlength=size + 1)[1:]
                    sums = np.bincount(key, g, size + 1)[1:].astype(np.int64)  # exact: below 2 ** WHOLE_BITS
                    held = np.flatnonzero(n)
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array(np.full(len(held), part, np.int32)), "key": pa.array(held.astype(np.int64)),
                        "g": pa.array(sums[held]), "n": pa.array(n[held].astype(np.int64))})

        return (self.data.mapInArrow(run, "part int, key long, g long, n long")
                .groupBy("part", "key").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).toArrow())


def _gathered(batches, width: int):
    """(x, y) as numpy arrays, some ROWS_PER_BLOCK rows at a time."""
    held, size = [], 0
    for batch in chain(batches, [None]):
        if batch is not None and batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if held and (batch is None or size >= ROWS_PER_BLOCK):
            table = pa.Table.from_batches(held)
            x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column("x").chunks])
            yield x.reshape(-1, width), table.column("y").to_numpy()
            held, size = [], 0


def _block(bins: np.ndarray, y: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({c: pa.array([np.ascontiguousarray(a).tobytes()], pa.binary())
                                       for c, a in (("b", bins), ("y", y), ("p", p))})


class _Levels:
    """Histograms by one aggregate per level."""

    def __init__(self, blocks: _Blocks, scale: float, features: list[int]):
        self.blocks, self.scale, self.features = blocks, scale, features

    def of(self, tree: Tree, nodes: set[int]):
        """(node, feature, bin, gradient, rows) of these nodes."""
        depth, features = self.blocks.depth, self.features
        feature, last, _ = tree.full(depth)
        asked = np.array(sorted(nodes))
        place = np.full(2 ** (depth + 1), -1)
        place[asked] = np.arange(len(asked))

        def keys(bins):
            node = place[growing.place_in_full(bins, feature, last, depth)]
            for f in features:
                yield f, np.where(node < 0, -1, node * BINS + bins[:, f]), len(asked) * BINS

        found = self.blocks.sums(self.scale, keys)
        for f, key, g, n in zip(*(found.column(c).to_pylist() for c in ("part", "key", "g", "n"))):
            yield int(asked[key // BINS]), f, key % BINS, g, n


class _Cube:
    """Histograms of all levels from the sums per combination of the drawn features' bins."""

    def __init__(self, blocks: _Blocks, scale: float, features: list[int], sizes: list[int]):
        self.features = features

        def keys(bins):
            key = np.zeros(len(bins), np.int64)
            for f, size in zip(features, sizes):
                key = key * size + bins[:, f]
            yield 0, key, prod(sizes)

        cells = blocks.sums(scale, keys)
        self.bins = dict(zip(features, np.unravel_index(cells.column("key").to_numpy(), sizes)))
        self.g, self.n = cells.column("g").to_numpy(), cells.column("n").to_numpy()

    def of(self, tree: Tree, nodes: set[int]):
        inside = {1: np.ones(len(self.g), bool)}
        for node in sorted(tree.splits):
            feature, last = tree.splits[node]
            left = self.bins[feature] <= last
            inside[2 * node], inside[2 * node + 1] = inside[node] & left, inside[node] & ~left
        for node in nodes:
            cells = inside[node]
            for feature in self.features:
                bins = self.bins[feature][cells]
                size = int(bins.max()) + 1
                g, n = np.zeros(size, np.int64), np.zeros(size, np.int64)
                np.add.at(g, bins, self.g[cells])
                np.add.at(n, bins, self.n[cells])
                for bin_ in np.flatnonzero(n):
                    yield node, feature, int(bin_), int(g[bin_]), int(n[bin_])


class _Settings(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of a tree", TypeConverters.toInt)
    step = Param(Params._dummy(), "step", "share of each tree's weights that is added", TypeConverters.toFloat)
    columns = Param(Params._dummy(), "columns", "share of the features drawn per tree", TypeConverters.toFloat)
    alpha = Param(Params._dummy(), "alpha", "L1 term of leaf weights", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "L2 term of leaf weights", TypeConverters.toFloat)
    leastRows = Param(Params._dummy(), "leastRows", "rows of a leaf, at least", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "of the draws", TypeConverters.toInt)


class HistogramBoosting(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """The estimator. A NaN among the features lies in the last bin of its feature."""

    def __init__(self, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction", *,
                 trees: int = 100, depth: int = 6, step: float = 0.3, columns: float = 1.0, alpha: float = 0.0,
                 l2: float = 1.0, leastRows: float = 1.0, seed: int = 0):
        super().__init__()
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol, trees=trees, depth=depth,
                  step=step, columns=columns, alpha=alpha, l2=l2, leastRows=leastRows, seed=seed)

    def _fit(self, dataset: DataFrame) -> BoostedTrees:
        shared_dir(dataset.sparkSession)
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"),
                              F.col(self.getLabelCol()).cast("double").alias("y")).where("y IS NOT NULL")
        sums = rows.agg(F.count(F.lit(1)).alias("rows"), F.avg("y").alias("mean"), F.max(F.size("x")).alias("width"),
                        F.max(F.abs("y")).alias("most")).first()
        if not sums["rows"]:
            raise ValueError("no rows to fit")
        base, width = sums["mean"], sums["width"]
        cuts = cut_points(rows, width)
        ship(dataset.sparkSession)
        blocks = _Blocks(rows, cuts, base, self.getOrDefault("depth"))
        # Predictions may swing beyond the labels, by far less than this factor.
        scale = 2.0 ** (WHOLE_BITS - floor(log2(sums["rows"] * 16 * max(sums["most"], 1e-300))) - 1)
        draw = random.Random(self.getOrDefault("seed"))
        drawn = max(1, floor(self.getOrDefault("columns") * width + 1e-9))
        grown: list[Tree] = []
        for _ in range(self.getOrDefault("trees")):
            features = sorted(draw.sample(range(width), drawn))
            sizes = [len(cuts[f]) + 1 for f in features]
            histograms = (_Cube(blocks, scale, features, sizes) if prod(sizes) <= CELLS
                          else _Levels(blocks, scale, features))
            grown.append(self._grown(histograms, features, scale))
            blocks.grow(grown[-1])
        model = BoostedTrees(self.getFeaturesCol(), self.getPredictionCol(), base=base, depth=self.getOrDefault("depth"),
                             forest=json.dumps([_flat(tree, cuts, self.getOrDefault("depth")) for tree in grown]))
        return self._copyValues(model)

    def _grown(self, histograms: _Levels | _Cube, features: list[int], scale: float) -> Tree:
        """One tree, level by level."""
        alpha, l2 = self.getOrDefault("alpha"), self.getOrDefault("l2")
        tree, open_nodes, held = Tree(), {1}, {}
        for _ in range(self.getOrDefault("depth")):
            by_node: dict[int, dict[int, list]] = {}
            for node, feature, bin_, g, n in histograms.of(tree, open_nodes):
                by_node.setdefault(node, {}).setdefault(feature, []).append((bin_, g / scale, n))
            open_nodes = set()
            for k in sorted(by_node):
                if k == 1:
                    first = by_node[1][features[0]]
                    held[1] = sum(g for _, g, _ in first), sum(n for _, _, n in first)
                found = best_split(by_node[k], alpha, l2, self.getOrDefault("leastRows"))
                if found:
                    _, feature, last, held[2 * k], held[2 * k + 1] = found
                    tree.splits[k] = feature, last
                    open_nodes |= {2 * k, 2 * k + 1}
            if not open_nodes:
                break
        step = self.getOrDefault("step")
        tree.weights = {k: -step * soft_threshold(g, alpha) / (n + l2) for k, (g, n) in held.items()
                        if k not in tree.splits}
        return tree


def _flat(tree: Tree, cuts: list[list[float]], depth: int) -> dict[str, list]:
    """The tree as arrays over the nodes of a full one: what a leaf holds stands in the leftmost place below it, where
    rows arrive because no value is above an infinite cut."""
    size = 2 ** (depth + 1)
    feature, cut, weight = [0] * size, [inf] * size, [0.0] * size
    for node, (at, last) in tree.splits.items():
        feature[node], cut[node] = at, cuts[at][last]
    for node, value in tree.weights.items():
        while 2 * node < size:
            node *= 2
        weight[node] = value
    return {"feature": feature, "cut": [c if c < inf else None for c in cut], "weight": weight}


def _predictor(trees: list[dict[str, list]], depth: int, base: float):
    """An Arrow function of an array of features: the sum of what the trees give, in their order."""
    feature = np.array([tree["feature"] for tree in trees], np.int64)
    cut = np.array([[inf if c is None else c for c in tree["cut"]] for tree in trees])
    weight = np.array([tree["weight"] for tree in trees])
    width = int(feature.max()) + 1
    most = BATCH_ROWS

    def predicted(features):
        import numpy as np
        import pyarrow as pa

        total = np.full(len(features), base)
        for start in range(0, len(features), most):
            part = features.slice(start, most)
            x = np.full((len(part), max(width, 1)), -np.inf)  # a row without features goes left everywhere
            known = np.flatnonzero(part.is_valid().to_numpy(zero_copy_only=False))
            if len(known):
                x[known] = part.flatten().to_numpy(zero_copy_only=False).reshape(len(known), -1)[:, :x.shape[1]]
            x[np.isnan(x)] = np.finfo(np.float64).max  # a NaN is in the last bin of its feature
            flat, row = np.ascontiguousarray(x).reshape(-1), np.arange(len(part)) * x.shape[1]
            for one, at, what in zip(feature, cut, weight):
                node = np.ones(len(part), np.int64)
                for _ in range(depth):
                    node = 2 * node + (flat[row + one[node]] > at[node])
                total[start:start + most] += what[node]
        return pa.array(total)

    return predicted


def with_predictions(dataset: DataFrame, features: str, name: str, predicted) -> DataFrame:
    """The rows with what `predicted` gives for the Arrow array of their features."""
    kept = [c for c in dataset.columns if c != name]
    rows = dataset.select(*kept, vector_to_array(features).alias("__x"))
    schema = dataset.select(*kept, F.lit(None).cast("double").alias(name)).schema

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, predicted(batch.column("__x"))], [*kept, name])

    return rows.mapInArrow(run, schema)


class BoostedTrees(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted trees. A prediction walks down them with all rows of an Arrow batch at once."""

    base = Param(Params._dummy(), "base", "prediction before the first tree", TypeConverters.toFloat)
    depth = Param(Params._dummy(), "depth", "levels of a tree", TypeConverters.toInt)
    forest = Param(Params._dummy(), "forest", "the trees, as JSON", TypeConverters.toString)

    def __init__(self, featuresCol: str = "features", predictionCol: str = "prediction", *, base: float = 0.0,
                 depth: int = 0, forest: str = "[]"):
        super().__init__()
        self._set(featuresCol=featuresCol, predictionCol=predictionCol, base=base, depth=depth, forest=forest)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, depth = json.loads(self.getOrDefault("forest")), self.getOrDefault("depth")
        if not trees:
            return dataset.withColumn(self.getPredictionCol(), F.lit(self.getOrDefault("base")))
        total = _predictor(trees, depth, self.getOrDefault("base"))
        return with_predictions(dataset, self.getFeaturesCol(), self.getPredictionCol(), total)
