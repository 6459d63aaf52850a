"""Connected components of a graph of links, by hooking and pointer doubling on DataFrames.

In every round each node that has a smaller neighbour hooks on to the smallest of them. That gives trees, as pointers
lead to smaller nodes only; each tree is folded into its top, the smallest of its nodes, and the links between tops are
the next round's. A top that nothing has hooked on to has only smaller neighbours then and hooks on itself, so that two
rounds at least halve the nodes. The pointers of all rounds are one forest, whose tops are the components.

Steps are aggregations and equi-joins; no node's neighbours are gathered, and a node with very many links is reduced
before the shuffle and joined by splittable partitions. Each step is stored in the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .stored import forget, stored

MOST_ROUNDS = 60


def tops(parents: DataFrame) -> DataFrame:
    """(node, component) of a forest given as (node, parent), one row for each node that has a parent; component is the
    top of its tree. Every step doubles the way that a pointer leads up, until all are known to end at a top."""
    at, done, before = parents, F.lit(False), None
    for _ in range(MOST_ROUNDS):
        above = at.select(F.col("node").alias("parent"), F.col("parent").alias("above"), done.alias("done"))
        higher = stored(at.select("node", "parent").join(above, "parent", "left")
                        .select("node", F.coalesce("above", "parent").alias("parent"),
                                F.coalesce("done", F.lit(True)).alias("done")), "tops")
        if before is not None:
            forget(before)
        if higher.filter("NOT done").isEmpty():
            return higher.select("node", F.col("parent").alias("component"))
        at, done, before = higher, F.col("done"), higher
    raise RuntimeError("pointers did not settle")


def forest(links: DataFrame) -> DataFrame:
    """(node, parent) of trees that join what the stored links (a, b) join; the top of each is its smallest node."""
    links, before, rounds = _downward(links), None, []
    while not links.isEmpty():
        if len(rounds) == MOST_ROUNDS:
            raise RuntimeError("components did not settle")
        # Read back, so that joins deal out both sides anew.
        hooks = stored(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent")), "hooks")
        found = tops(hooks)
        forget(hooks)
        rounds.append(found.withColumnRenamed("component", "parent"))
        folded = (links.join(found.select(F.col("node").alias("a"), F.col("component").alias("top")), "a")
                  .select(F.col("top").alias("a"), "b")
                  .join(found.select(F.col("node").alias("b"), F.col("component").alias("top")), "b", "left")
                  .select("a", F.coalesce("top", "b").alias("b")))
        links = stored(_downward(folded).distinct(), "links")
        if before is not None:
            forget(before)
        before = links
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("parent"))
    return reduce(DataFrame.unionByName, rounds)


def _downward(links: DataFrame) -> DataFrame:
    """The links with the greater node first; none from a node to itself."""
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def with_tops(found: DataFrame) -> DataFrame:
    """The rows of `tops`, and one for each top itself."""
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the smallest node that can be reached."""
    return with_tops(tops(forest(stored(links, "links"))))
