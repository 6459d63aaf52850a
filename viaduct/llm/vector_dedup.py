"""Near-duplicate vectors: all pairs of cosine 0.9 or more, by cover trees in blocks.

1. Vectors with the same components are one class from here on, so that copies are never compared; a class has the
   weight of its rows.
2. A cover tree over at most CENTRES classes, drawn by hash, gives the homes: every class goes to the nearest of these
   points, and each home's count and covering radius are taken over all classes. Homes that follow each other in the
   tree are packed into blocks; a home that is too large for one block is dealt into several by hash.
3. Every block builds cover trees of its vectors (`cover_tree`), TREE at most to a tree and in the order of the homes,
   which are stored: level, parent and position of each vector. That is the index, and it holds every vector.
4. Two blocks meet unless all pairs of their homes lie too far apart by their covering radii. Blocks that meet travel
   to one task, which goes down every pair of their trees. It gives one row per linked vector: the weight that it is linked
   with there, and the group it belongs to. Pairs are never listed, so a large group of near copies gives no more rows
   than it has vectors.
5. Weights are summed per vector, and groups are joined by `components`.

All pairs at the threshold are found; the sample only decides how well blocks can be told apart. Vectors without any
structure leave all blocks to meet, and then each row travels once per block it meets and the work grows with the
square of the table: blocks are as large as BLOCK_BYTES allows, to keep the copies few, vectors of a float column travel
in single precision, and pairs of points are first held against a bound over the main directions of the sample
(`main_directions`), as `cover_tree` explains. The work of building trees grows with the rows only.

Vectors that are null, empty, zero, or hold a null or non-finite component are linked with nothing. Vectors of
different length are not compared; the lengths that a column holds are few. Rows that repeat an id are rows of their
own: each counts as a link of the other if their vectors are alike. Null ids rank last when a component is named, and
the component of null ids alone is null. An empty table gives an empty result. Columns other than the two named are
not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .cover_tree import RADII, SLACK, CoverTree, Groups, Traversal, depth_first, distance, heads, levels_of
from .grouping import groups_of
from .shipping import ship
from .stored import drawn_by_hash, forget, stored
from .vectors import usable, vector_of

COSINE = 0.9
CENTRES = 1024
BLOCK_BYTES = 1 << 25   # of a block's unit vectors
LEAST_BLOCK = 512       # rows
TREE = 4096             # rows
LINKS_HELD = 1 << 20
DECIDED = 8000          # columns of a bound that cost as much as one cosine taken by itself


def _kind(frame: DataFrame, vector: str) -> type:
    """The type of number that holds a column's components as they are."""
    return np.float32 if dict(frame.dtypes)[vector] == "array<float>" else np.float64


def _unit(vectors: list[bytes], kind: type) -> np.ndarray:
    """Unit vectors in double precision; the length is taken after scaling, so that it neither over- nor underflows."""
    x = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _keyed(frame: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, key, vector) of every row; key and vector are null if the row cannot be linked."""
    kind = _kind(frame, vector)
    rows = frame.select(F.col(id).alias("id"), vector_of(vector).alias("vector"))
    kinds = rows.select("id", F.lit(None).cast("binary").alias("key"), F.lit(None).cast("binary").alias("vector")).schema

    def run(batches):
        for batch in batches:
            keys, vectors = [None] * batch.num_rows, [None] * batch.num_rows
            for row, one in zip(*usable(batch.column("vector")), strict=True):
                if one.any():
                    vectors[row] = (one + 0.0).astype(kind).tobytes()  # minus zero is zero
                    keys[row] = hashlib.blake2b(vectors[row], digest_size=16).digest()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(keys, pa.binary()),
                                              pa.array(vectors, pa.binary())], names=["id", "key", "vector"])

    return rows.mapInArrow(run, kinds).transform(stored)


def _sampled(classes: DataFrame, most: int, kind: type) -> dict[int, np.ndarray]:
    """Unit vectors of the drawn classes by the length of their vectors, in the order of their cover tree."""
    drawn: dict[int, list[bytes]] = {}
    for row in drawn_by_hash(classes.select("key", "vector"), "key", most, classes.count()).collect():
        drawn.setdefault(len(row["vector"]) // np.dtype(kind).itemsize, []).append(row["vector"])
    trees = {}
    for size, vectors in drawn.items():
        x = _unit(vectors, kind)
        trees[size] = x[depth_first(*levels_of(x))]
    return trees


def main_directions(x: np.ndarray, cosine: float) -> np.ndarray | None:
    """As many of the main directions of unit vectors, as columns, as make bounds cheapest: few columns to multiply,
    few pairs that the bound leaves. None if whole vectors are cheaper."""
    size = x.shape[1]
    directions = np.linalg.svd(x, full_matrices=False)[2].T
    pairs = np.triu_indices(len(x), 1)

    def cost(columns: int, basis: np.ndarray | None) -> float:
        head = heads(x, basis)
        left = (head @ head.T)[pairs] >= cosine
        return columns + DECIDED * left.mean() if len(left) else columns

    best, least = None, cost(size, None)
    for eighths in (1, 2, 3, 4, 6):
        columns = max(1, size * eighths // 8)
        if columns <= directions.shape[1] and (spent := cost(columns + 1, directions[:, :columns])) < least:
            best, least = directions[:, :columns], spent
    return best


def _at_home(classes: DataFrame, centres: dict[int, np.ndarray], kind: type) -> DataFrame:
    """The classes with size (of the vector), home (the nearest centre's number) and away (the distance to it)."""
    shared = classes.sparkSession.sparkContext.broadcast(centres)
    kinds = classes.select("node", "weight", "vector", F.lit(0).alias("size"), F.lit(0).alias("home"),
                           F.lit(0.0).alias("away")).schema

    def run(batches):
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            sizes = np.array([len(one) // np.dtype(kind).itemsize for one in vectors], np.int32)
            home, away = np.zeros(len(vectors), np.int32), np.full(len(vectors), RADII[0])
            for size in np.unique(sizes):
                if size in shared.value:
                    rows = np.flatnonzero(sizes == size)
                    cosine = _unit([vectors[r] for r in rows], kind) @ shared.value[size].T
                    home[rows] = cosine.argmax(axis=1)
                    away[rows] = distance(cosine.max(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("weight"), batch.column("vector"), pa.array(sizes),
                 pa.array(home), pa.array(away)], names=["node", "weight", "vector", "size", "home", "away"])

    return classes.mapInArrow(run, kinds).transform(stored)


@dataclass(frozen=True)
class Plan:
    """How homes go into blocks. The blocks of a run of homes are numbered from `base` on."""
    homes: list[tuple[int, int, int, int]]  # size, home, base, number of blocks
    meets: list[tuple[int, int, int]]       # base, base and number of blocks of a run that it meets, itself included
    pairs: int


def plan(stats: list[tuple[int, int, int, float]], centres: dict[int, np.ndarray], limit: float, cores: int) -> Plan:
    """`stats` holds (size, home, classes, radius) of the homes. There are at most CENTRES of them, and one per vector
    length that the sample does not hold."""
    homes, meets, base, pairs = [], [], 0, 0
    everything = sum(n for _, _, n, _ in stats)
    # Enough pairs of blocks to keep the cores busy.
    aim = max(LEAST_BLOCK, ceil(everything / sqrt(8 * cores)))
    for size in sorted({row[0] for row in stats}):
        mine = sorted(row[1:] for row in stats if row[0] == size)
        rows = max(1, min(aim, BLOCK_BYTES // (8 * size)))
        runs, held = [], 0
        for k, (home, n, _) in enumerate(mine):
            if not runs or held + n > rows:
                runs.append([])
                held = 0
            runs[-1].append(k)
            held += n
        placed = []
        for run in runs:
            blocks = ceil(sum(mine[k][1] for k in run) / rows)
            placed.append((base, blocks))
            homes += [(size, mine[k][0], base, blocks) for k in run]
            base += blocks
        radius = np.array([r for _, _, r in mine])
        if size in centres:
            x = centres[size][[home for home, _, _ in mine]]
            near = distance(x @ x.T) <= limit + radius[:, None] + radius[None, :] + SLACK
        else:
            near = np.ones((len(mine), len(mine)), bool)
        starts = [run[0] for run in runs]
        near = np.logical_or.reduceat(np.logical_or.reduceat(near, starts, axis=0), starts, axis=1)
        np.fill_diagonal(near, True)
        for i, j in zip(*np.nonzero(near), strict=True):
            meets.append((placed[i][0], *placed[j]))
            pairs += placed[i][1] * placed[j][1]
    return Plan(homes, meets, (pairs + base) // 2)


def _indexed(placed: DataFrame, partitions: int, kind: type) -> DataFrame:
    """(block, base, at, level, parent, node, weight, vector): every block's trees one after the other, each in
    depth-first order; parents are numbered within their tree."""
    rows = placed.repartition(partitions, "block").sortWithinPartitions("block", "home", "node")
    kinds = placed.select("block", "base", F.lit(0).alias("at"), F.lit(0).alias("level"), F.lit(0).alias("parent"),
                          "node", "weight", "vector").schema

    def run(batches):
        for block in groups_of(batches, ["block"]):
            cuts = np.linspace(0, len(block), ceil(len(block) / TREE) + 1).astype(int)
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                tree = block.slice(start, end - start)
                level, parent = levels_of(_unit(tree.column("vector").to_pylist(), kind))
                order = depth_first(level, parent)
                place = np.argsort(order)
                sorted_ = tree.take(pa.array(order))
                yield from pa.Table.from_arrays(
                    [sorted_.column("block"), sorted_.column("base"), pa.array(np.arange(start, end, dtype=np.int32)),
                     pa.array(level[order].astype(np.int32)), pa.array(place[parent[order]].astype(np.int32)),
                     *[sorted_.column(c) for c in ("node", "weight", "vector")]],
                    names=["block", "base", "at", "level", "parent", "node", "weight", "vector"]).to_batches()

    return rows.mapInArrow(run, kinds).transform(stored)


def _tree(rows: pa.Table, bases: dict[int, np.ndarray | None], kind: type) -> CoverTree:
    x = _unit(rows.column("vector").to_pylist(), kind)
    return CoverTree(x, *[rows.column(c).to_numpy().astype(np.int64) for c in ("level", "parent", "weight")],
                     bases.get(x.shape[1]))


def _between(trees: list[CoverTree], pairs: list[tuple[int, int]], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Per point of the trees, one after the other: the weight that it is linked with, and its group."""
    starts = np.cumsum([0] + [len(tree.x) for tree in trees])
    gain, groups, links, held = np.zeros(starts[-1], np.int64), Groups(starts[-1]), [], 0
    for one, two in pairs:
        found = Traversal(trees[one], trees[two], cosine)
        some = np.flatnonzero(found.gain)
        if not len(some):
            continue
        points = np.arange(starts[one], starts[one + 1])
        if one != two:
            points = np.concatenate([points, np.arange(starts[two], starts[two + 1])])
        gain[points[some]] += found.gain[some]
        some = some[found.groups.label[some] != some]
        links.append((points[some], points[found.groups.label[some]]))
        held += len(some)
        if held > LINKS_HELD:
            groups.join(*map(np.concatenate, zip(*links, strict=True)))
            links, held = [], 0
    if links:
        groups.join(*map(np.concatenate, zip(*links, strict=True)))
    return gain, groups.label


def _met(index: DataFrame, meets: DataFrame, partitions: int, cosine: float, bases: dict[int, np.ndarray | None],
         kind: type) -> DataFrame:
    """(node, gain, root) of the vectors that are linked, for every pair of blocks that meet."""
    shared = index.sparkSession.sparkContext.broadcast(bases)
    rows = (index.join(F.broadcast(meets), "base")
            .withColumn("other", F.explode(F.expr("sequence(first, first + blocks - 1)")))
            .select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "at",
                    "level", "parent", "node", "weight", "vector")
            .repartition(partitions, "i", "j").sortWithinPartitions("i", "j", "block", "at"))
    kinds = rows.select("node", F.lit(0).cast("long").alias("gain"), F.lit(0).cast("long").alias("root")).schema

    def run(batches):
        for rows in groups_of(batches, ["i", "j"]):
            node, block = rows.column("node").to_numpy(), rows.column("block").to_numpy()
            starts = np.flatnonzero(rows.column("level").to_numpy() == 0)  # only a root is on level 0
            trees = [_tree(rows.slice(start, end - start), shared.value, kind)
                     for start, end in zip(starts, [*starts[1:], len(node)], strict=True)]
            mine = int((block[starts] == rows.column("i")[0].as_py()).sum())
            if mine == len(trees):
                pairs = [(k, m) for k in range(mine) for m in range(k, mine)]
            else:
                pairs = [(k, m) for k in range(mine) for m in range(mine, len(trees))]
            del rows, block
            gain, label = _between(trees, pairs, cosine)
            some = np.flatnonzero(gain > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[some]), pa.array(gain[some]), pa.array(node[label[some]])],
                names=["node", "gain", "root"])

    return rows.mapInArrow(run, kinds).transform(stored)


def linked_vectors(frame: DataFrame, id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
                   centres: int = CENTRES) -> DataFrame:
    """Per row: the id, n_links (other rows of that cosine or more), component_id (smallest id that links reach, its
    own included), kept (whether the id is that of the component)."""
    spark = frame.sparkSession
    ship(spark)
    keyed = _keyed(frame, id, vector)
    classes = (keyed.filter("key IS NOT NULL").groupBy("key")
               .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"), F.min("vector").alias("vector"))
               # The number holds for the stored table.
               .select(F.monotonically_increasing_id().alias("node"), "key", "id", "weight", "vector")
               .transform(stored))
    kind = _kind(frame, vector)
    trees = _sampled(classes, centres, kind)
    housed = _at_home(classes, trees, kind)
    stats = housed.groupBy("size", "home").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()
    cores = spark.sparkContext.defaultParallelism
    planned = plan([tuple(row) for row in stats], trees, sqrt(2 - 2 * cosine), cores)
    # A few partitions more than there are groups to deal, as these fall unevenly; large tables have many a partition.
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * cores)
    homes = spark.createDataFrame(planned.homes, "size int, home int, base long, blocks int")
    placed = (housed.join(F.broadcast(homes), ["size", "home"])
              .withColumn("block", F.col("base") + F.pmod(F.xxhash64("node"), F.col("blocks")))
              .select("block", "base", "home", "node", "weight", "vector"))
    n_blocks = sum({base: blocks for _, _, base, blocks in planned.homes}.values())
    index = _indexed(placed, min(most, max(1, 3 * n_blocks)), kind)
    forget(housed)
    meets = spark.createDataFrame(planned.meets, "base long, first long, blocks int")
    bases = {size: main_directions(x, cosine) for size, x in trees.items()}
    met = _met(index, meets, min(most, max(1, 3 * planned.pairs)), cosine, bases, kind)
    forget(index)

    gained = met.groupBy("node").agg((F.sum("gain") - 1).alias("n_links"))
    joined = components(met.select(F.col("node").alias("a"), F.col("root").alias("b"))).transform(stored)
    named = classes.select("node", "key", "id").join(gained, "node").join(joined, "node", "left")
    named = named.select("key", "id", "n_links", F.coalesce("component", "node").alias("component")).transform(stored)
    # A component that holds most of the table is named before its rows meet the name.
    first = named.groupBy("component").agg(F.min("id").alias("component_id")).transform(stored)
    known = named.join(first, "component").select("key", "n_links", "component_id").transform(stored)
    rows = keyed.select("id", "key").join(known, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.select(F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                       component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
