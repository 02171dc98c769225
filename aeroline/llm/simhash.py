"""Near duplicates by SimHash, found through deletion variants of fingerprint segments."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroline.llm.graph import components, forest
from aeroline.session import staged

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Start and width of the segments. Two fingerprints at ``DISTANCE`` differ by at most one bit in one of three.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Groups of more fingerprints are first linked by lookup, see :func:`_dense`.
DENSE = 1024
_FOLD = 1 << 18


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint: a bit is 1 if set in over half the hashes of the word shingles; no words: 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0] + [e + 1 for e in ends[:-1]]
    digest, span = xxhash.xxh64_digest, min(shingle, len(words))
    counts, spans, total = np.zeros(64, np.int64), list(zip(starts, ends[span - 1:])), len(words) - span + 1
    for at in range(0, total, _FOLD):
        hashes = b"".join([digest(line[a:b], SEED) for a, b in spans[at:at + _FOLD]])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) per row; a null text has no words. Other columns are left behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [simhash(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.int64())], ["doc_id", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, fingerprint long")


def _variants(marks: DataFrame) -> DataFrame:
    """One row per fingerprint and wildcard bit: segment and bit in the high bits, the segment without that bit below."""
    keys = []
    for segment, (start, width) in enumerate(SEGMENTS):
        part = F.shiftrightunsigned("fingerprint", start).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            label = (segment << 5 | bit) << 22
            keys.append(part.bitwiseAND(F.lit(~(1 << bit))).bitwiseOR(F.lit(label)))
    return marks.select("fingerprint", F.explode(F.array(*keys)).alias("key"))


def _dense(marks: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest that connects the different ``marks`` of a large group as all their links do.

    Near copies of one text differ in the few bits that are nearly even, so most of them are one bit apart, and that is
    looked up in order. Only what lies outside the largest component of this is compared, with all the others.
    """
    sorted_marks = np.sort(marks.view(np.uint64))
    left, right = [], []
    for bit in range(64):
        other = sorted_marks ^ np.uint64(1 << bit)
        place = np.minimum(np.searchsorted(sorted_marks, other), len(other) - 1)
        hit = (sorted_marks[place] == other) & (sorted_marks < other) & (distance > 0)
        left.append(sorted_marks[hit].view(np.int64))
        right.append(other[hit].view(np.int64))
    a, b = forest(np.concatenate(left), np.concatenate(right))
    roots, sizes = np.unique(b, return_counts=True)
    largest = roots[sizes.argmax()] if len(roots) else marks[0]
    inside = np.r_[largest, a[b == largest]]
    order = np.r_[inside, np.setdiff1d(marks, inside)]
    left, right, held = [a], [b], 0
    for i in range(len(inside), len(order)):
        near = np.flatnonzero(np.bitwise_count((order[:i] ^ order[i]).view(np.uint64)) <= distance)
        # One link into the largest component says what all of them would.
        near = near[np.searchsorted(near, len(inside)) - 1:] if len(near) and near[0] < len(inside) else near
        left.append(np.full(len(near), order[i]))
        right.append(order[near])
        held += len(near)
        if held > 500_000:
            a, b = forest(np.concatenate(left), np.concatenate(right))
            left, right, held = [a], [b], 0
    return forest(np.concatenate(left), np.concatenate(right))


def _close(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Verified links among the fingerprints of each key, contracted to a forest so that dense groups stay linear."""
    got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not got:
        return
    marks, keys = (np.concatenate(x) for x in zip(*got))
    order = np.argsort(keys, kind="stable")
    marks, keys = marks[order], keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    ends = np.repeat(starts + sizes, sizes)
    left, right, held = [], [], 0
    for start, size in zip(starts[sizes > DENSE].tolist(), sizes[sizes > DENSE].tolist()):
        a, b = _dense(marks[start:start + size], distance)
        left.append(a)
        right.append(b)
        held += len(a)
        if held > 500_000:
            a, b = forest(np.concatenate(left), np.concatenate(right))
            left, right, held = [a], [b], 0
    at, step = np.flatnonzero(np.repeat(sizes <= DENSE, sizes)), 1
    at = at[at + 1 < ends[at]]
    while len(at):
        near = np.bitwise_count((marks[at] ^ marks[at + step]).view(np.uint64)) <= distance
        left.append(marks[at[near]])
        right.append(marks[at[near] + step])
        held += int(near.sum())
        if held > 500_000:
            a, b = forest(np.concatenate(left), np.concatenate(right))
            left, right, held = [a], [b], 0
        step += 1
        at = at[at + step < ends[at]]
    if left and sum(map(len, left)):
        a, b = forest(np.concatenate(left), np.concatenate(right))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def links(marks: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``a``, ``b`` of different fingerprints that connect all those at ``distance`` (4 or 5 at most) or fewer.

    ``marks`` has distinct fingerprints. Every link of the graph is kept up to connection: a task returns a spanning
    forest of what it has verified, so a dense group of n fingerprints gives n - 1 rows.
    """
    if distance >= 2 * len(SEGMENTS):
        raise ValueError("segments that differ by at most one bit cannot cover this distance")
    dealt = _variants(marks.select("fingerprint")).repartition("key")
    return dealt.mapInArrow(lambda batches: _close(batches, distance), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long), ``component_id`` per row of ``docs`` (``doc_id``, ``text``).

    ``component_id`` is the smallest doc_id that links reach; equal fingerprints are linked. Texts without words have
    fingerprint 0 and are linked like others. Rows without a doc_id take no part and have no component. An id that
    occurs twice belongs to the smallest component that one of its rows reaches through its own fingerprint. An empty table gives no rows.
    """
    rows = staged(fingerprints(docs, shingle), "simhash")
    marks = staged(
        rows.where("doc_id IS NOT NULL").groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-marks")
    found = components(links(marks, distance)).withColumnRenamed("node", "fingerprint")
    named = marks.join(found, "fingerprint", "left").withColumn("group", F.coalesce("component", "fingerprint"))
    groups = named.groupBy("group").agg(F.min("first_id").alias("component_id"))
    known = named.join(groups, "group").select("fingerprint", "component_id")
    out = rows.join(known, "fingerprint", "left")
    return out.select("doc_id", "fingerprint", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def without_copies(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, the one with the smallest doc_id.

    All columns stay. Rows without a doc_id stay.
    """
    found = near_duplicates(docs, shingle, distance)
    rest = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(rest, "doc_id", "left_anti").select(docs.columns)
