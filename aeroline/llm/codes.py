"""Exact top-k search over binary codes of any length by incremental multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aeroline.session import staged

BITS = 64
#: Codes that share a segment value beyond this number are split, and probes of that value go to every part.
BLOCK = 20_000


def sign_codes(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``id``, ``code``: bit i of the code is 1 if component i is over 0. Missing components, nulls and NaN give 0.

    A code is a long; if any vector has more than 64 components, it is an array of as many longs as the longest one needs.
    Rows without id or vector have no code.
    """
    rows = vectors.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull())
    rows = rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("v"))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 1
    bit = lambda x, i: F.when((x > 0) & ~F.isnan(x), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    words = [F.aggregate(F.transform(F.slice("v", at + 1, BITS), bit), F.lit(0).cast("long"), lambda x, y: x.bitwiseOR(y)) for at in range(0, max(1, longest), BITS)]
    return rows.select("id", (words[0] if len(words) == 1 else F.array(*words)).alias("code"))


def segments_for(n: int) -> int:
    """Number of segments of a long: the width nearest to the logarithm of the number of codes among 8, 16 and 21 or 22 bits."""
    return 8 if n < 1 << 12 else 4 if n < 1 << 24 else 3


def _cuts(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment of a long; widths differ by one at most."""
    ends = [BITS * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def _keyed(codes: DataFrame, longs: int, segments: int) -> DataFrame:
    """A row per code and segment; ``key`` is the number of the segment above bit 32 and its value."""
    keys = [
        F.shiftrightunsigned(F.col("code")[w], at).bitwiseAND(F.lit((1 << width) - 1)).bitwiseOR(F.lit((w * segments + i) << 32))
        for w in range(longs) for i, (at, width) in enumerate(_cuts(segments))]
    return codes.select("code", F.explode(F.array(*keys)).alias("key"))


def _masks(width: int, radius: int) -> np.ndarray:
    """All values of ``width`` bits with ``radius`` ones."""
    return np.fromiter((sum(1 << i for i in c) for c in combinations(range(width), radius)), np.int64, comb(width, radius))


def _longs(column: pa.Array, longs: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, longs)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1]), pa.int32()), pa.array(values.ravel()))


def _probes(queries: DataFrame, longs: int, segments: int, radius: int) -> DataFrame:
    """``key``, ``code``, ``most`` for every segment value at exactly ``radius`` bits from that of each query code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = {width: _masks(width, radius) for _, width in _cuts(segments)}
        step = max(1, 200_000 // max(map(len, masks.values()), default=1))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                code, most = _longs(part.column(0), longs), part.column(1).to_numpy()
                for w in range(longs):
                    for i, (first, width) in enumerate(_cuts(segments)):
                        own = masks[width]
                        for piece in range(0, len(own), 200_000):
                            some = own[piece:piece + 200_000]
                            value = (code[:, w] >> first) & ((1 << width) - 1)
                            keys = ((value[:, None] ^ some[None, :]) | ((w * segments + i) << 32)).ravel()
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(keys), _lists(np.repeat(code, len(some), axis=0)), pa.array(np.repeat(most, len(some)))], ["key", "code", "most"])

    return queries.mapInArrow(run, "key long, code array<long>, most int")


def _verify(batches: Iterator[pa.RecordBatch], k: int, longs: int) -> Iterator[pa.RecordBatch]:
    """Index rows (``most`` < 0) and probes of one partition meet by key and part; each query keeps its ``k`` best codes."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    table = pa.Table.from_batches(got)
    key, part_of, most = (table.column(c).to_numpy() for c in ("key", "part", "most"))
    code = _longs(table.column("code").combine_chunks(), longs)
    # Keys with their parts as running numbers.
    key = np.unique(np.c_[key, part_of.astype(np.int64)], axis=0, return_inverse=True)[1].ravel()
    probe = most >= 0
    order = np.argsort(key[~probe], kind="stable")
    keys, codes = key[~probe][order], code[~probe][order]
    key, own, most = key[probe], code[probe], most[probe]
    first, last = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
    hits = np.flatnonzero(last > first)
    out_query, out_code, out_distance = [], [], []
    at, budget = 0, 1 << 20
    while at < len(hits):
        sizes = (last - first)[hits[at:]]
        n = max(1, int(np.searchsorted(np.cumsum(sizes), budget, "right")))
        part, sizes = hits[at:at + n], sizes[:n]
        at += n
        places = np.repeat(first[part], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        away = np.bitwise_count((np.repeat(own[part], sizes, axis=0) ^ codes[places]).view(np.uint64)).sum(axis=1, dtype=np.int32)
        near = away <= np.repeat(most[part], sizes)
        out_query.append(np.repeat(own[part], sizes, axis=0)[near])
        out_code.append(codes[places][near])
        out_distance.append(away[near])
        if at >= len(hits) or sum(map(len, out_query)) > budget:
            q, c, d = (np.concatenate(x) for x in (out_query, out_code, out_distance))
            kept = _top(q, c, d, k)
            out_query, out_code, out_distance = [q[kept]], [c[kept]], [d[kept]]
    if out_query:
        yield pa.RecordBatch.from_arrays([_lists(out_query[0]), _lists(out_code[0]), pa.array(out_distance[0])], ["query", "found", "distance"])


def _top(query: np.ndarray, code: np.ndarray, distance: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's different codes up to the distance of its ``k`` th; ties at that distance all stay."""
    if not len(query):
        return np.zeros(0, np.int64)
    order = np.lexsort((*code.T, distance, *query.T))
    q, c = query[order], code[order]
    order = order[np.r_[True, (q[1:] != q[:-1]).any(axis=1) | (c[1:] != c[:-1]).any(axis=1)]]
    q, d = query[order], distance[order]
    starts = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]).any(axis=1)])
    sizes = np.diff(np.r_[starts, len(q)])
    kth = d[starts + np.minimum(sizes, k) - 1]
    return order[d <= np.repeat(kth, sizes)]


def search(rows: DataFrame, queries: DataFrame, k: int = 10, segments: int | None = None) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id``, ``distance``: exactly the ``k`` nearest other rows by Hamming distance.

    ``rows`` and ``queries`` have ``id`` and ``code`` (a long, or an array of longs; codes of one search are equally long), others
    are left behind; rows with a null in either are left out. Ties go to the smaller id. Fewer than ``k`` candidates: all of
    them. Equal rows are one row and equal queries one query; rows of one id with different codes are ranked on their own, and a
    query id with several codes asks with the smallest.

    The longs of a code are cut into ``segments`` each. Round r probes, for each open query, the segment values at distance r
    from its own. After it every code within (all segments) x (r + 1) - 1 has been met; a query whose k-th verified distance
    is at most that is done. Equal codes are searched once and stand for their smallest ids. Results do not depend on the
    number of segments, nor on whether a segment value is split (:data:`BLOCK`).
    """
    def listed(frame: DataFrame) -> DataFrame:
        frame = frame.select("id", "code").where("id IS NOT NULL AND code IS NOT NULL").distinct()
        return frame if frame.schema["code"].dataType.typeName() == "array" else frame.withColumn("code", F.array("code"))

    rows, queries = listed(rows), listed(queries).groupBy("id").agg(F.min("code").alias("code"))
    longs = rows.agg(F.max(F.size("code"))).first()[0] or 1
    need = k + 1  # the query's own row may be among them
    first = F.row_number().over(W.partitionBy("code").orderBy("id"))
    ids = staged(rows.withColumn("n", first).where(F.col("n") <= need).select("code", "id"), "code-ids")
    codes = staged(ids.select("code").distinct(), "codes")
    segments = segments or segments_for(codes.count())
    width, every = max(width for _, width in _cuts(segments)), longs * segments
    index = _keyed(codes, longs, segments)
    hot = staged(index.groupBy("key").count().where(F.col("count") > BLOCK).select(
        "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("pieces")), "hot-keys")
    split = not hot.isEmpty()
    no_part = F.lit(0)
    index = index.join(hot, "key", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("code"), F.col("pieces")).cast("int"), no_part)) if split else index.withColumn("part", no_part)
    index = index.select("key", "part", "code", F.lit(-1).alias("most"))

    active = staged(queries.select("code", F.lit(BITS * longs).alias("most")).distinct(), "open-queries")
    found = None
    for radius in range(width + 1):
        probes = _probes(active, longs, segments, radius)
        if split:
            probes = probes.join(hot, "key", "left").withColumn("part", F.explode(F.sequence(no_part, F.coalesce("pieces", F.lit(1)) - 1)))
        else:
            probes = probes.withColumn("part", no_part)
        dealt = index.union(probes.select("key", "part", "code", "most")).repartition("key", "part")
        met = dealt.mapInArrow(lambda batches: _verify(batches, need, longs), "query array<long>, found array<long>, distance int")
        met = met if found is None else met.union(found)
        best = F.rank().over(W.partitionBy("query").orderBy("distance"))
        found = staged(met.distinct().withColumn("place", best).where(F.col("place") <= need).drop("place"), "found")
        state = found.groupBy("query").agg(F.count("*").alias("n"), F.max("distance").alias("kth"))
        covered = every * (radius + 1) - 1
        bound = F.when(F.col("n") >= need, F.col("kth")).otherwise(F.lit(BITS * longs))
        active = staged(active.select("code").join(state, F.col("code") == F.col("query"), "left").withColumn(
            "most", F.coalesce(bound, F.lit(BITS * longs)).cast("int")).where(F.col("most") > covered).select("code", "most"), "open-queries")
        if active.isEmpty():
            break
    near = found.join(ids.select(F.col("code").alias("found"), "id"), "found")
    asked = queries.select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    pairs = asked.join(near, "query").where(F.col("id") != F.col("query_id"))
    place = F.row_number().over(W.partitionBy("query_id").orderBy("distance", "id"))
    return pairs.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")
