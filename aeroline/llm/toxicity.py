"""Toxicity: two Kneser-Ney models of word pairs, of toxic and of ordinary texts, over shared backoff counts."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroline.session import staged

#: Words are told apart by 20 bits of a hash; one more class stands for the beginning of a text.
CLASSES = 1 << 20
START = CLASSES
#: Contexts taken off each count and handed to the shared distribution; what occurs in fewer is no evidence of its own.
DISCOUNT = 4.0
#: Weight of the shared distribution besides, as a part of all counts.
SHARED = 1.0
#: Nats by which a word has to stand out from the median word of its text.
MARGIN = 1.0
THRESHOLD = 0.7
#: Labelled ids that are broadcast at most (about 50 MB as a hash table).
BROADCAST = 1_000_000
#: Of the texts to learn from, one in so many calibrates the score; the others are counted.
CALIBRATION = 4
#: Steps of the histogram of log ratios that calibration looks at, per nat, and its last bin.
_STEPS, _LAST = 4096, 1 << 16
_CHUNK = 1 << 20
_BUFFER = 1 << 21
_PARTS = 1 << 16
_DOCS_A_PART = 256


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1)
def _powers() -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(1023, 0x9E3779B97F4A7C15, np.uint64)], dtype=np.uint64)


def _classes_of(codes: np.ndarray) -> np.ndarray:
    letter = _letters()[codes]
    at = np.flatnonzero(letter)
    if not len(at):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, np.diff(at) > 1])
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
    mixed = np.add.reduceat((codes[at].astype(np.uint64) + np.uint64(1)) * _powers()[place & 1023], first)
    for shift, factor in ((31, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed ^= mixed >> np.uint64(shift)
        mixed *= np.uint64(factor)
    return (mixed >> np.uint64(44)).astype(np.int64)


def word_classes(text: str) -> Iterator[np.ndarray]:
    """Classes of the words of a text, runs of letters in lower case, in order. Long texts come in chunks cut between words."""
    at, size = 0, len(text)
    while at < size:
        end = min(size, at + _CHUNK)
        if end < size:
            cut = end
            while cut > at and text[cut - 1].isalpha():
                cut -= 1
            # A single word longer than a chunk is read to its end.
            while cut == at and end < size and text[end].isalpha():
                end += 1
            end = cut if cut > at else end
        got = _classes_of(np.frombuffer(text[at:end].lower().encode("utf-32-le", "surrogatepass"), np.uint32))
        if len(got):
            yield got
        at = end


def _pairs(text: str) -> Iterator[np.ndarray]:
    """Each word with the one before it, as one number."""
    before = START
    for words in word_classes(text):
        yield np.r_[before, words[:-1]] * (CLASSES + 1) + words
        before = words[-1]


def labelled(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """``text``, ``toxic``, ``counted`` of the documents to learn from: those with a label for which ``learn`` holds.

    A document is toxic if any of its labels says so; null labels and null ids say nothing. ``counted`` parts the texts for
    the models from those for calibration, by id. Up to ``BROADCAST`` labelled ids are sent to the texts; with more of them
    labels and texts meet by a shuffle. Rows are the same.
    """
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    marks = staged(marks, "toxic-labels")
    marks = F.broadcast(marks) if marks.count() <= BROADCAST else marks
    texts = docs.where(learn).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return texts.join(marks, "doc_id").select("text", "toxic", (F.floor(rest / 3) % CALIBRATION != 0).alias("counted"))


def pair_counts(docs: DataFrame) -> DataFrame:
    """``pair``, ``ordinary``, ``toxic``: how often each word class follows each other one, in either kind of text.

    Counts all occurrences in all of ``docs`` (``text``, ``toxic``), one row per pair: a word's class and the class before it as
    one number. Tasks add up equal pairs before the shuffle, and pairs are dealt by their hash, so that a frequent word is
    spread over all tasks.
    """
    parts = min(_PARTS, max(64, docs.count() // _DOCS_A_PART))

    def rows(kept: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs, times = np.unique(np.concatenate(kept), return_counts=True)
        part = ((pairs >> 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % parts
        order = np.argsort(part, kind="stable")
        ends = np.searchsorted(part[order], np.arange(parts + 1))
        present = np.flatnonzero(np.diff(ends))
        offsets = pa.array(np.r_[ends[present], len(pairs)], pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v[order])) for v in (pairs, times.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([pa.array(present, pa.int32()), *lists], ["part", "pairs", "times"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                for pairs in _pairs(text.as_py()):
                    kept.append(pairs * 2 + toxic)
                    size += len(pairs)
                    if size >= _BUFFER:
                        yield from rows(kept)
                        kept, size = [], 0
        if kept:
            yield from rows(kept)

    def count(group: pa.Table) -> pa.Table:
        pairs, times = (group.column(c).combine_chunks().flatten().to_numpy() for c in ("pairs", "times"))
        names, place = np.unique(pairs >> 1, return_inverse=True)
        sums = [np.bincount(place, times * (pairs & 1 == kind), len(names)).astype(np.int64) for kind in (0, 1)]
        return pa.Table.from_arrays([pa.array(v) for v in (names, *sums)], ["pair", "ordinary", "toxic"])

    dealt = docs.select("text", "toxic").mapInArrow(summed, "part int, pairs array<long>, times array<int>")
    return dealt.groupBy("part").applyInArrow(count, "pair long, ordinary long, toxic long")


def continuations(pairs: DataFrame) -> DataFrame:
    """``word``, ``ordinary``, ``toxic``, ``shared``: in how many different contexts each word class follows, from :func:`pair_counts`.

    A context is the class of the word before. ``shared`` counts contexts of either kind of text.
    """
    # A class follows at most all classes and the beginning, so counts are small numbers.
    follows = [F.count_if(F.col(kind) > 0).cast("int").alias(kind) for kind in ("ordinary", "toxic")]
    return pairs.groupBy((F.col("pair") % (CLASSES + 1)).cast("int").alias("word")).agg(*follows, F.count("*").cast("int").alias("shared"))


def contexts(docs: DataFrame) -> DataFrame:
    """The continuation counts (:func:`continuations`) of all of ``docs`` (``text``, ``toxic``)."""
    return continuations(pair_counts(docs))


def followed(pairs: DataFrame) -> DataFrame:
    """``before``, and of all pairs that begin with it how many there are and how many are kept after the discount.

    ``ordinary``, ``toxic`` and ``shared`` are counts, each with its ``kept_``. Only words with pairs that are kept in ``shared``:
    after the others the shared counts hand everything to the lower level.
    """
    kinds = {"ordinary": F.col("ordinary"), "toxic": F.col("toxic"), "shared": F.col("ordinary") + F.col("toxic")}
    sums = [F.sum(n).cast("double").alias(kind) for kind, n in kinds.items()]
    kept = [F.sum(F.greatest(n - DISCOUNT, F.lit(0.0))).alias(f"kept_{kind}") for kind, n in kinds.items()]
    before = F.floor(F.col("pair") / (CLASSES + 1)).cast("int").alias("before")
    return pairs.groupBy(before).agg(*sums, *kept).where("kept_shared > 0")


@dataclass
class Model:
    """Log ratios (toxic over ordinary) of word classes after any word, and of the pairs that the upper level knows.

    ``pairs`` is sorted. ``slope`` and ``offset`` are the line that turns a text's ratio into a probability.
    """

    ratio: np.ndarray
    pairs: np.ndarray
    pair_ratio: np.ndarray
    slope: float = 0.0
    offset: float = 0.0

    def text_ratio(self, text: str | None) -> float:
        """How far the words of a text stand out as toxic, in nats per word; 0 without words.

        A word counts by how much its log ratio exceeds the text's median by more than ``MARGIN``: language and topic move all
        words of a text alike, and so its median. Mean over all words, so long and short texts compare.
        """
        found = [self.log_ratio(pairs) for pairs in _pairs(text or "")]
        if not found:
            return 0.0
        values = np.concatenate(found)
        return float(np.maximum(values - np.median(values) - MARGIN, 0).sum(dtype=float) / len(values))

    def log_ratio(self, pairs: np.ndarray) -> np.ndarray:
        """Log ratio of each word after the one before it."""
        values = self.ratio[pairs % (CLASSES + 1)]
        if len(self.pairs):
            place = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            values = np.where(self.pairs[place] == pairs, self.pair_ratio[place], values)
        return values

    def probability(self, ratio: float) -> float:
        return 1 / (1 + math.exp(-min(50.0, max(-50.0, self.slope * ratio + self.offset))))


def shares(counts: np.ndarray) -> list[np.ndarray]:
    """Ordinary and toxic probability of each word class after any word, from ``counts`` (ordinary, toxic, shared; each per class).

    Kneser-Ney: a word has its discounted share of its kind's contexts, and the discounted mass, with ``SHARED`` besides,
    goes by the contexts it has in both kinds. A word of few contexts is so left to the shared counts, which favour neither.
    """
    shared = counts[2] + 0.5
    shared = shared / shared.sum()
    found = []
    for own in counts[:2]:
        total = own.sum()
        kept = np.maximum(own - DISCOUNT, 0)
        found.append((kept + (total - kept.sum() + SHARED * total) * shared) / (total * (1 + SHARED)))
    return found


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Log of toxic over ordinary probability per word class, see :func:`shares`."""
    ordinary, toxic = (np.log(p) for p in shares(counts))
    return (toxic - ordinary).astype(np.float32)


def pair_ratios(pairs: DataFrame, lower: list[np.ndarray]) -> DataFrame:
    """``pair``, ``ratio``: log of toxic over ordinary probability of the later word after the earlier one.

    The upper level of Kneser-Ney, over the lower level ``lower`` (:func:`shares`). A pair has its discounted share of its kind's
    pairs with the same beginning; the discounted mass, with ``SHARED`` besides, goes by the discounted counts of both kinds.
    What the discount takes off the counts of both kinds is the weight of the lower level. It is the same for either kind:
    there is far less toxic text, and weights of each kind's own would favour toxicity for every pair that is rare.
    Pairs that are not in the result keep nothing in the shared counts, and their ratio is that of the later word alone.
    """
    found = followed(pairs).toArrow()
    names = ("ordinary", "toxic", "shared", "kept_ordinary", "kept_toxic", "kept_shared")
    before = found.column("before").to_numpy()
    order = np.argsort(before)
    known = pairs.sparkSession.sparkContext.broadcast((before[order], np.stack([found.column(n).to_numpy()[order] for n in names]), lower))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, sums, lower = known.value
        for batch in batches:
            pair, *own = (c.to_numpy() for c in batch.columns)
            at, word = np.searchsorted(before, pair // (CLASSES + 1)), pair % (CLASSES + 1)
            both = (own[0] + own[1] - DISCOUNT) / sums[5, at]
            weight = sums[5, at] / sums[2, at]
            logs = []
            for kind in (0, 1):
                total, kept = np.maximum(sums[kind, at], 1), sums[3 + kind, at]
                upper = (np.maximum(own[kind] - DISCOUNT, 0) + (total - kept + SHARED * total) * both) / (total * (1 + SHARED))
                logs.append(np.log(weight * upper + (1 - weight) * lower[kind][word]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((logs[1] - logs[0]).astype(np.float32))], ["pair", "ratio"])

    return pairs.where(F.col("ordinary") + F.col("toxic") > DISCOUNT).mapInArrow(run, "pair long, ratio float")


def _line(bins: np.ndarray, toxic: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through a histogram (Newton steps with a little ridge)."""
    positive = float(times[toxic == 1].sum())
    share = (positive + 1) / (times.sum() + 2)
    if positive in (0.0, float(times.sum())):
        return 0.0, math.log(share / (1 - share))
    middle = np.average(bins, weights=times)
    spread = math.sqrt(np.average((bins - middle) ** 2, weights=times))
    if spread == 0:
        return 0.0, math.log(share / (1 - share))
    design = np.c_[(bins - middle) / spread, np.ones(len(bins))]
    line = np.array([1.0, math.log(share / (1 - share))])
    for _ in range(100):
        at = 1 / (1 + np.exp(-np.clip(design @ line, -30, 30)))
        slope = design.T @ (times * (at - toxic))
        curve = (design * (times * at * (1 - at))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        line -= step
        if np.abs(step).max() < 1e-9:
            break
    a, b = max(0.0, line[0] / spread), line[1] - line[0] * middle / spread
    return float(a), float(b)


def _with_ratio(rows: DataFrame, model: Model, names: list[str]) -> DataFrame:
    """``names`` of ``rows`` and the ``ratio`` of its ``text``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ratios = [shared.value.text_ratio(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(ratios, pa.float64())], [*names, "ratio"])

    chosen = rows.select("text", *names)
    types = {f.name: f.dataType.simpleString() for f in chosen.schema}
    return chosen.mapInArrow(run, ", ".join(f"{n} {types[n]}" for n in names) + ", ratio double")


def fit(learn: DataFrame) -> Model:
    """The model of all rows of :func:`labelled`.

    Counts cover all of them; the driver gets three numbers per word class, at most a million classes, six per class that
    begins a pair kept after the discount, the ratios of these pairs, and a histogram of the ratios of the calibration texts. Without texts of both kinds nothing tells them apart, and every score is the share
    of toxic ones.
    """
    counts = np.zeros((3, CLASSES))
    pairs = staged(pair_counts(learn.where("counted")), "toxic-pairs")
    got = continuations(pairs).toArrow()
    place = got.column("word").to_numpy()
    for row, name in enumerate(("ordinary", "toxic", "shared")):
        counts[row, place] = got.column(name).to_numpy()
    model = Model(np.zeros(CLASSES, np.float32), np.zeros(0, np.int64), np.zeros(0, np.float32))
    if counts[:2].any(axis=1).all():
        upper = pair_ratios(pairs, shares(counts)).toArrow()
        order = np.argsort(upper.column("pair").to_numpy())
        model = Model(log_ratios(counts), upper.column("pair").to_numpy()[order], upper.column("ratio").to_numpy()[order])
    bins = F.least(F.floor(F.col("ratio") * _STEPS), F.lit(_LAST)).alias("bin")
    seen = _with_ratio(learn.where(~F.col("counted")), model, ["toxic"]).groupBy(bins, "toxic").count().toPandas()
    model.slope, model.offset = _line((seen["bin"].to_numpy(float) + 0.5) / _STEPS, seen["toxic"].to_numpy(float), seen["count"].to_numpy(float))
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """Column: whether the crc32 of the id as text leaves a rest of 1 by 3; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (probability of a toxic label), ``predicted`` (score at least 0.7), ``ratio`` per row of ``docs``.

    Learns from labelled documents that are not held out; only the text decides a score. Null and empty texts have no words and
    get the score of a text that does not stand out. Repeated rows are scored each; contexts are counted once, pairs each time.
    Extra columns are left behind; an empty table gives no rows, and without labels every score is 0.5.
    """
    model = fit(labelled(docs, labels, ~held_out()))
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    line = F.least(F.greatest(F.col("ratio") * model.slope + model.offset, F.lit(-50.0)), F.lit(50.0))
    scored = _with_ratio(rows, model, ["doc_id"]).withColumn("score", 1 / (1 + F.exp(-line)))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "ratio")
