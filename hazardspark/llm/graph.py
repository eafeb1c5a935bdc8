"""Components of links: in a task as stars, over a table by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardspark.session import cut_lineage, rewritten


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value that a link joins with others, and the least value that it reaches by the given links."""
    values, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    i, j = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    own = label != np.arange(len(values))
    return values[own], values[label[own]]


def merged(parts: Iterator[tuple[np.ndarray, np.ndarray]], most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of many steps as few stars: what has gathered is joined again and again, and leaves at the end or where its
    distinct nodes alone are too many to hold."""
    one, two, held = [], [], 0
    for a, b in parts:
        one.append(a)
        two.append(b)
        held += len(a)
        if held > most:
            a, b = stars(np.concatenate(one), np.concatenate(two))
            if len(a) > most // 2:
                yield a, b
                one, two, held = [], [], 0
            else:
                one, two, held = [a], [b], len(a)
    if held:
        yield stars(np.concatenate(one), np.concatenate(two))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and root (the least node it reaches) of every node that has an edge, from edges (a, b)."""
    now = rewritten(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def stamp(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())

    before = stamp(now)
    for _ in range(rounds):
        if not before[0]:
            break
        # Large star: every greater neighbour of a node points to the node's least neighbour.
        both = cut_lineage(now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        least = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut_lineage(large.where("a <> b"))
        # Small star: a node and its lesser neighbours point to the least of them.
        least = cut_lineage(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = rewritten(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        after = stamp(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
