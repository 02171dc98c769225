"""Connected components: a numpy form for one task's edges, and alternating stars for the whole graph."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroline.session import staged


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the edges ``a``-``b`` connect."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        label = label[label]
        if np.array_equal(before, label) and np.array_equal(label[left], label[right]):
            break
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node hands its neighbours (the larger ones, or itself and the smaller ones) to the smallest."""
    pairs = edges.select("a", "b")
    if large:
        pairs = pairs.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = pairs.groupBy("a").agg(F.min("b").alias("low"))
    # Written, so that the join is one of two plain tables: its hubs can be split, and a short list is broadcast.
    low = staged(low.select("a", F.least("a", "low").alias("low")), "lowest")
    joined = pairs.join(low, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node of ``edges`` (two long columns, any names).

    Large-star and small-star steps alternate until nothing moves; each step is a written table, so a lost executor
    costs one step. A hub's edges are a join side, which adaptive execution can split.
    """
    first, second = (F.col(c) for c in edges.columns[:2])
    now = edges.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b"))
    now = staged(now.where(F.col("a") != F.col("b")).distinct(), "edges")
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == tuple(seen):
            break
        state = tuple(seen)
        now = staged(_stars(staged(_stars(now, True), "large-star"), False), "small-star")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
