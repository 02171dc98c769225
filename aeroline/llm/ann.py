"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aeroline.session import staged

SAMPLE = 20_000
BRANCHING = 12
LEAF = 48
PROBES = 200
RECALL = 0.97
#: Rows of one leaf that one task compares; a larger leaf is split, its queries go to every part.
BLOCK = 4096
#: Queries that one task meets at most, about.
QUERIES = 50_000
_ALIKE = 1e-9


class Tree:
    """Nodes in one table: centre, and for inner nodes the place of their children. Leaves are numbered from 0."""

    def __init__(self, points: np.ndarray, branching: int = BRANCHING, leaf: int = LEAF, seed: int = 7):
        self.centres, self.children, self.leaf_of, self.leaves = [points.mean(axis=0) if len(points) else np.zeros(points.shape[1])], [None], [-1], 0
        random, todo = np.random.default_rng(seed), [(0, points)]
        while todo:
            node, own = todo.pop()
            parts = self._split(own, branching, random) if len(own) > leaf else None
            if parts is None:
                self.leaf_of[node] = self.leaves
                self.leaves += 1
                continue
            first = len(self.centres)
            self.children[node] = range(first, first + len(parts))
            for part in parts:
                self.centres.append(part.mean(axis=0))
                self.children.append(None)
                self.leaf_of.append(-1)
            todo += [(first + i, part) for i, part in enumerate(parts)]
        self.centres = np.array(self.centres)

    @staticmethod
    def _split(points: np.ndarray, k: int, random: np.random.Generator) -> list[np.ndarray] | None:
        """Lloyd's k-means on one node; None if the points cannot be parted."""
        centres = np.unique(points[random.choice(len(points), min(len(points), 4 * k), replace=False)], axis=0)
        centres = centres[random.permutation(len(centres))[:k]]
        for _ in range(8):
            near = distances(points, centres).argmin(axis=1)
            centres = np.array([points[near == i].mean(axis=0) for i in range(len(centres)) if (near == i).any()])
        near = distances(points, centres).argmin(axis=1)
        parts = [points[near == i] for i in range(len(centres)) if (near == i).any()]
        return parts if len(parts) > 1 else None

    def visit(self, point: np.ndarray, most: int | None = None) -> Iterator[int]:
        """Leaves in best-bin-first order: the queue always opens the node with the nearest centre."""
        queue, given = [(0.0, 0)], 0
        while queue and (most is None or given < most):
            _, node = heapq.heappop(queue)
            if self.children[node] is None:
                given += 1
                yield self.leaf_of[node]
                continue
            below = self.children[node]
            away = ((self.centres[below.start:below.stop] - point) ** 2).sum(axis=1)
            for child, distance in zip(below, away.tolist()):
                heapq.heappush(queue, (distance, child))

    def assign(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point: down the nearest centres."""
        out, todo = np.zeros(len(points), np.int32), [(0, np.arange(len(points)))]
        while todo:
            node, own = todo.pop()
            if self.children[node] is None:
                out[own] = self.leaf_of[node]
                continue
            below = self.children[node]
            near = distances(points[own], self.centres[below.start:below.stop]).argmin(axis=1)
            todo += [(child, own[near == i]) for i, child in enumerate(below) if (near == i).any()]
        return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``, up to rounding."""
    return np.maximum((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :], 0)


def usable(vectors: DataFrame, id_column: str, vector_column: str, length: int | None = None) -> DataFrame:
    """``id``, ``v`` (array of double) of the rows that take part: a vector without null or non-finite parts, not zero,
    of the given length, or else the length that most rows have (ties: the shorter). Equal rows are one row."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine)
    if length is not None:
        return rows.where(F.size("v") == length).distinct()
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").take(1)
    return rows.where(F.size("v") == lengths[0]["n"]).distinct() if lengths else rows


def sampled(rows: DataFrame, size: int) -> list:
    """About ``size`` rows (all, if there are no more), chosen by a hash of their id and put in its order.

    The bound of the hash follows from the number of rows, so that no other row is sorted or sent anywhere: a table of any
    size costs a count and a filter. Of rows that share an id the smallest vector is taken. The number of rows is random
    about ``size`` and never over twice it.
    """
    total = rows.count()
    mark = F.xxhash64("id")
    if total > size:
        rows = rows.where(mark < F.lit(int(size / total * 2 ** 64) - 2 ** 63))
    chosen = rows.groupBy("id").agg(F.min("v").alias("v")).select("id", "v", mark.alias("mark"))
    return sorted(chosen.limit(2 * size).collect(), key=lambda r: (r["mark"], r["id"]))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def best(ids: np.ndarray, points: np.ndarray, query: np.ndarray, query_id: int, rough: np.ndarray, k: int) -> list[tuple[float, int]]:
    """The ``k`` nearest to the query, ties by id; ``rough`` are squared distances up to rounding, checked exactly here."""
    own = ids != query_id
    ids, points, rough = ids[own], points[own], rough[own]
    if len(ids) > k:
        kth = np.partition(rough, k - 1)[k - 1]
        near = rough <= kth + _ALIKE * (1 + kth + (query * query).sum())
        ids, points = ids[near], points[near]
    exact = np.sqrt(((points - query) ** 2).sum(axis=1))
    order = np.lexsort((ids, exact))[:k]
    return [(float(exact[i]), int(ids[i])) for i in order]


def _search(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """Rows of one part of a leaf against the queries that visit it, in blocks of queries."""
    out = []
    if len(left) and len(right):
        points, ids = np.array(left["v"].tolist()), left["id"].to_numpy()
        for at in range(0, len(right), 512):
            part = right.iloc[at:at + 512]
            wanted = np.array(part["v"].tolist())
            for query_id, query, rough in zip(part["query_id"].tolist(), wanted, distances(wanted, points)):
                out += [(query_id, i, d) for d, i in best(ids, points, query, query_id, rough, k)]
    return pd.DataFrame(out, columns=["query_id", "id", "score"])


def exact_neighbours(rows: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """``query_id``, ``id``, ``score``: brute force for a bounded list of queries against all ``rows`` (``id``, ``v``), in blocks."""
    ids, points = np.array([q[0] for q in queries]), np.array([q[1] for q in queries], dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1))
            found = [(q, i, d) for q, p, rough in zip(ids.tolist(), points, distances(points, vectors)) for d, i in best(own, vectors, p, q, rough, k)]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(found, columns=["query_id", "id", "score"]), preserve_index=False)

    near = rows.mapInArrow(run, "query_id long, id long, score double")
    return near.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("score", "id"))).where(F.col("rank") <= k)


class Index:
    """A tree over all rows of a vector table, and how many leaves a query has to open.

    The tree is fitted on about ``SAMPLE`` rows, those with small id hashes, and is broadcast: its size depends on the
    sample only. Every row is indexed. ``visits`` is calibrated against all rows: for ``PROBES`` rows, again by hash,
    the true neighbours come from brute force, and visits widen until they hold ``RECALL`` of them.
    """

    def __init__(self, vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 10,
                 sample: int = SAMPLE, branching: int = BRANCHING, leaf: int = LEAF, recall: float = RECALL):
        self.spark, self.k = vectors.sparkSession, k
        rows = staged(usable(vectors, id_column, vector_column), "ann-rows")
        seen = sampled(rows, sample)
        self.empty = not seen
        if self.empty:
            self.rows = rows
            return
        self.dimension = len(seen[0]["v"])
        self.tree = Tree(np.array([r["v"] for r in seen], dtype=np.float64), branching, leaf)
        self.shared = self.spark.sparkContext.broadcast(self.tree)
        shared = self.shared

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf_ids = shared.value.assign(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf_ids)], ["id", "v", "leaf"])

        self.rows = staged(rows.mapInArrow(place, "id long, v array<double>, leaf int"), "ann-leaves")
        # Row counts per leaf: as many rows as the tree has leaves.
        self.sizes = {r["leaf"]: r["count"] for r in self.rows.groupBy("leaf").count().collect()}
        self.parts = [max(1, -(-self.sizes.get(i, 0) // BLOCK)) for i in range(self.tree.leaves)]
        self.visits = self._calibrate([(r["id"], r["v"]) for r in seen[:PROBES]], recall)

    def _calibrate(self, probes: list, recall: float) -> int:
        true = exact_neighbours(self.rows.select("id", "v"), probes, self.k)
        held = true.join(self.rows.select("id", "leaf"), "id").select("query_id", "leaf").collect()  # PROBES x k rows
        points, depth, orders = dict(probes), [], {}
        for r in held:
            if r["query_id"] not in orders:
                order = self.tree.visit(np.array(points[r["query_id"]]))
                orders[r["query_id"]] = {leaf: i + 1 for i, leaf in enumerate(order)}
            depth.append(orders[r["query_id"]][r["leaf"]])
        return int(np.sort(depth)[max(0, int(np.ceil(recall * len(depth))) - 1)]) if depth else 1

    def search(self, queries: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
        """``query_id``, ``rank`` (from 1), ``id``, ``score``: the nearest rows found, the row of the query's own id left out.

        Queries with unusable vectors, or of another length than the indexed ones, are left out; equal queries are one query,
        and an id with several vectors asks with the smallest. Equal rows are one row, rows of one id with different vectors are
        ranked on their own. Duplicate vectors tie and the smaller id wins. If the leaves visited hold fewer than ``k`` rows, the visit goes on until they do or the
        tree is exhausted.
        """
        schema = "query_id long, rank int, id long, score double"
        if self.empty:
            return self.spark.createDataFrame([], schema)
        shared, visits, parts, k = self.shared, self.visits, self.parts, self.k
        wanted = usable(queries, id_column, vector_column, self.dimension).groupBy("id").agg(F.min("v").alias("v"))
        sizes, shares = self.sizes, max(1, -(-wanted.count() // QUERIES))

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree = shared.value
            for batch in batches:
                owner, leaf, part = [], [], []
                points = _matrix(batch.column(1)) if batch.num_rows else []
                for i, point in enumerate(points):
                    held = 0
                    for opened, at in enumerate(tree.visit(point)):
                        if opened >= visits and held > k:
                            break
                        held += sizes.get(at, 0)
                        if at in sizes:
                            owner += [i] * parts[at]
                            leaf += [at] * parts[at]
                            part += range(parts[at])
                own = batch.take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(leaf, pa.int32()), pa.array(part, pa.int32())], ["query_id", "v", "leaf", "part"])

        asked = wanted.select(F.col("id").alias("query_id"), "v").mapInArrow(route, "query_id long, v array<double>, leaf int, part int")
        spread = self.rows
        hot = {i: int(p) for i, p in enumerate(parts) if p > 1}
        pieces = F.lit(0)
        if hot:  # at most rows / BLOCK leaves
            table = self.spark.createDataFrame(list(hot.items()), "leaf int, pieces int")
            spread = spread.join(table, "leaf", "left")
            pieces = F.coalesce(F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"), F.lit(0))
        spread = spread.select("id", "v", "leaf", pieces.alias("part"))
        # Very many queries are split as well, each share with a copy of the rows, so that no group outgrows a task.
        spread = spread.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))) if shares > 1 else F.lit(0))
        asked = asked.withColumn("share", F.pmod(F.xxhash64("query_id"), F.lit(shares)).cast("int"))
        near = spread.groupBy("leaf", "part", "share").cogroup(asked.groupBy("leaf", "part", "share")).applyInPandas(
            lambda left, right: _search(left, right, k), "query_id long, id long, score double")
        order = W.partitionBy("query_id").orderBy("score", "id")
        return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
