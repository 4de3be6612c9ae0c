"""Connected components of graphs that are too large for one task, and links between parts that are connected already."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stage


def follow(steps: DataFrame) -> DataFrame:
    """(node, root) for steps (node, root) that lead from node to node without a cycle: the end of each one's way.

    What a round has found is followed twice as far in the next. Both sides of the joins are tables, so partitions of
    a root that many nodes lead to can be split.
    """
    now = stage(steps)
    while True:
        on = now.select(F.col("node").alias("root"), F.col("root").alias("next"))
        then = stage(now.join(on, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        discard(now)
        now = then
        if then.where("moved").isEmpty():
            return then.select("node", "root")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of edges (u, v) but the lowest of each component, which is the root.

    Each round every node goes to the lowest node it has an edge with, if that is lower than itself, and on to the end
    of that way; the edges are then drawn between the ends, until none is left. Neighbourhoods are only aggregated,
    never gathered, and a node of many edges is split among tasks wherever they are joined.
    """
    left = stage(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    found = None
    while not left.isEmpty():
        # An edge's greater end has a lower neighbour; where it is the lowest one decides.
        ends = follow(left.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root")))
        if found is None:
            whole = ends
        else:
            on = ends.select(F.col("node").alias("root"), F.col("root").alias("next"))
            whole = stage(found.join(on, "root", "left").select("node", F.coalesce("next", "root").alias("root")).union(ends))
        one, two = (ends.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("u", "v"))
        drawn = left.join(one, "u", "left").select("v", F.coalesce("u_root", "u").alias("u")).join(two, "v", "left").select("u", F.coalesce("v_root", "v").alias("v"))
        now = stage(drawn.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
        discard(left)
        left, found = now, whole
    return found if found is not None else left.select(F.col("v").alias("node"), F.col("u").alias("root"))


def joins(label: np.ndarray, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of members that are near, as many as connect the labels (0, 1, ...) that near members connect. ``near(k,
    others)`` tells which of ``others`` are near member k; members of connected labels are not compared."""
    joined, out = np.arange(label.max() + 1), []
    for k in np.argsort(np.bincount(label)[label], kind="stable").tolist():
        others = np.flatnonzero(joined[label] != joined[label[k]])
        if not len(others):
            break
        some = others[near(k, others)]
        for x, first in zip(*np.unique(joined[label[some]], return_index=True), strict=True):
            out.append((k, int(some[first])))
            joined[joined == x] = joined[label[k]]
    return out


def blocks_that_meet(rows: DataFrame, most: int, by: list[str]) -> DataFrame:
    """A row for each pair of blocks (left, right) that a member belongs to. The main label's members and all others are
    cut into blocks of about ``most``; pairs of two blocks of the main label are left out, as they have one label."""
    is_main = F.col("label") == F.col("main")
    mains, rest = (F.ceil(x / most).cast("int") for x in (F.col("of_main"), F.col("members") - F.col("of_main")))
    # The others' blocks have the numbers 0 to rest - 1, the main label's the next ones.
    own = F.when(is_main, rest + F.pmod(F.xxhash64("class", *by), mains)).otherwise(F.pmod(F.xxhash64("class", *by), rest)).cast("int")
    partners = F.when(is_main, F.sequence(F.lit(0), rest - 1)).otherwise(F.sequence(F.lit(0), rest + mains - 1))
    out = rows.withColumn("own", own).withColumn("other", F.explode(partners))
    return out.withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other")).drop("other", "main", "of_main", "members")
