"""Quality classifier by co-training: a view of the text and a view of the metadata teach each other."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aeroline.session import staged

#: Bound of the labelled sample that the views are fitted on, taken by hash of the id. All unlabelled documents take part.
LABELLED = 8000
ROUNDS, PER_ROUND = 5, 200
#: A pseudo-label is passed on only if the view that gives it is that sure after calibration.
SURE = 0.97
KEEP = 0.5
INPUT = ("text", "lang", "source", "n_chars")

_CLASSES = 16
_PUNCTUATION = b".,;:!?'\"-"


def _byte_classes() -> np.ndarray:
    """Classes of bytes: blank, newline, lower, upper, digit, above ASCII, common punctuation by two, other signs by four."""
    table = np.zeros(256, np.int64)
    for b in range(256):
        c = chr(b)
        if c == "\n":
            table[b] = 1
        elif c.isspace() or b < 32:
            table[b] = 0
        elif b >= 128:
            table[b] = 5
        elif c.islower():
            table[b] = 2
        elif c.isupper():
            table[b] = 3
        elif c.isdigit():
            table[b] = 4
        elif b in _PUNCTUATION:
            table[b] = 6 if c in ".," else 7 if c in "!?" else 8
        else:
            table[b] = 9 + b % 7
    return table


_TABLE = _byte_classes()
TEXT_SIZE = _CLASSES * _CLASSES + 8
_LANGS, _SOURCES, _LENGTHS = 16, 64, 16
META_SIZE = _LANGS + _SOURCES + _LENGTHS + 3


def text_features(text: str | None) -> np.ndarray:
    """Frequencies of neighbouring byte classes, and measures of words and lines, over the whole text."""
    data = (text or "").encode()
    out = np.zeros(TEXT_SIZE, np.float32)
    if not data:
        out[-1] = 1
        return out
    for at in range(0, len(data), 1 << 20):
        classes = _TABLE[np.frombuffer(data[at:at + (1 << 20) + 1], np.uint8)]
        out[: _CLASSES * _CLASSES] += np.bincount(classes[:-1] * _CLASSES + classes[1:], minlength=_CLASSES * _CLASSES)
    out = np.sqrt(out / len(data))
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    n = max(1, len(words))
    out[-8:-1] = (
        np.log1p(len(words)) / 10, min(1, len(data) / n / 20), len(set(words)) / n, 1 - len(set(lines)) / max(1, len(lines)),
        min(1, len(lines) / n), min(1, max(map(len, words), default=0) / 100), len({w[-3:] for w in words}) / n)
    return out


def metadata_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(META_SIZE, np.float32)
    if lang is not None:
        out[crc32(lang.encode()) % _LANGS] = 1
    if source is not None:
        out[_LANGS + crc32(source.encode()) % _SOURCES] = 1
    if n_chars is not None and n_chars >= 0:
        out[_LANGS + _SOURCES + min(_LENGTHS - 1, int(np.log2(1 + n_chars)))] = 1
        out[-3] = np.log1p(n_chars) / 10
    out[-2] = lang is None
    out[-1] = source is None or n_chars is None
    return out


@dataclass
class View:
    """Logistic regression on standardized features, and the line that calibrates its margin."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        return self.slope * self.margin(x) + self.shift


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 25) -> np.ndarray:
    """Newton steps; the last weight is the constant and is not penalized."""
    x = np.c_[x, np.ones(len(x))]
    weights, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ weights)
        gradient = x.T @ (p - y) + ridge * weights
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge), gradient)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _fit_view(x: np.ndarray, y: np.ndarray, held_x: np.ndarray, held_y: np.ndarray) -> View:
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    view = View(mean, scale, _logistic((x - mean) / scale, y, penalty=3.0))
    if len(set(held_y)) == 2:
        line = _logistic(view.margin(held_x)[:, None], held_y, penalty=0.1)
        if line[0] > 0:
            view.slope, view.shift = float(line[0]), float(line[1])
    return view


@dataclass
class Model:
    text: View | None
    meta: View | None
    combine: np.ndarray
    passed_on: int = 0

    def score(self, text_x: np.ndarray, meta_x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of good quality by the text, by the metadata, and by both. Without two classes to learn: 1."""
        if self.text is None:
            one = np.ones(len(text_x))
            return one, one, one
        t, m = self.text.calibrated(text_x), self.meta.calibrated(meta_x)
        return _sigmoid(t), _sigmoid(m), _sigmoid(np.stack([t, m], axis=1) @ self.combine[:2] + self.combine[2])


def co_train(text_x: np.ndarray, meta_x: np.ndarray, y: np.ndarray, surest: Callable[[dict[str, View], dict[int, int], set[int]], dict]) -> Model:
    """Views on two thirds of the labelled rows; the other third calibrates and combines them.

    In each round both views label what they are surest of among the unlabelled documents, as many of each class as the
    labels suggest, and the other view learns from it. ``surest`` is given the views, the number wanted of each class and
    the ids that are taken, see :func:`_surest`.
    """
    if len(set(y.tolist())) < 2:
        return Model(None, None, np.zeros(3))
    held = np.arange(len(y)) % 3 == 2
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held = np.zeros(len(y), bool)
    fit, check = ~held, held if held.any() else ~held
    sets = {"text": (text_x[fit], y[fit]), "meta": (meta_x[fit], y[fit])}
    inputs = {"text": text_x, "meta": meta_x}
    share, passed_on, views, taken = y.mean(), 0, {}, set()
    wanted = {1: max(1, round(PER_ROUND * share)), 0: max(1, round(PER_ROUND * (1 - share)))}
    for turn in range(ROUNDS + 1):
        views = {k: _fit_view(*sets[k], inputs[k][check], y[check]) for k in sets}
        if turn == ROUNDS:
            break
        given = 0
        for (_, learner, label), found in surest(views, wanted, taken).items():
            x, labels = sets[learner]
            taken.update(i for i, _ in found)
            given += len(found)
            sets[learner] = (np.array([*x, *(row for _, row in found)]), np.r_[labels, np.full(len(found), label)])
        passed_on += given
        if not given:
            break
    odds = np.stack([views["text"].calibrated(text_x[check]), views["meta"].calibrated(meta_x[check])], axis=1)
    combine = _logistic(np.clip(odds, -20, 20), y[check], penalty=0.1)
    return Model(views["text"], views["meta"], combine, passed_on)


def _stack(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).astype(np.float64).reshape(-1, size)


def _surest(pool: DataFrame, views: dict[str, View], wanted: dict[int, int], taken: set[int]) -> dict[tuple[str, str, int], list[tuple[int, np.ndarray]]]:
    """By teacher, learner and label, in turn: ids of ``pool`` and the learner's features, the surest first.

    Every row is scored; a task hands on the few surest different ids of each teacher and label, and the best of all
    tasks reach the driver: a number of rows that depends on ``wanted`` only. An id goes once, by the row that its
    teacher is surest of; equally sure ones go in order of a hash.
    """
    turns = [("text", "meta", 1), ("text", "meta", 0), ("meta", "text", 1), ("meta", "text", 0)]
    most = 2 * sum(wanted.values())  # what the other teacher takes first may be among them
    out = np.array(sorted(taken), np.int64)
    # Sums by row: a row's certainty does not depend on the batch it is in.
    lines = {k: (v.mean, v.scale, v.weights, v.slope, v.shift) for k, v in views.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {turn: tuple(np.zeros(0, t) for t in (np.float64, np.int64, np.int64, np.int64)) for turn in range(len(turns))}
        for b in batches:
            ids, keys, marks = (b.column(i).to_numpy() for i in range(3))
            free = ~np.isin(ids, out)
            good = {}
            for teacher, column, size in (("text", 3, TEXT_SIZE), ("meta", 4, META_SIZE)):
                mean, scale, weights, slope, shift = lines[teacher]
                margin = ((_stack(b.column(column), size) - mean) / scale * weights[:-1]).sum(axis=1) + weights[-1]
                good[teacher] = _sigmoid(slope * margin + shift)
            for at, (teacher, _, label) in enumerate(turns):
                certainty = good[teacher] if label else 1 - good[teacher]
                some = np.flatnonzero((certainty >= SURE) & free)
                doubt, key, own, mark = (np.r_[x, new[some]] for x, new in zip(best[at], (-certainty, keys, ids, marks)))
                order = np.lexsort((mark, own, key, doubt))
                order = order[np.sort(np.unique(own[order], return_index=True)[1])][:most]
                best[at] = (doubt[order], key[order], own[order], mark[order])
        for at, (doubt, key, own, mark) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), at, np.int32)), *map(pa.array, (doubt, key, own, mark))], ["turn", "doubt", "key", "id", "mark"])

    rows = pool.select("id", "key", "mark", "text", "meta").mapInArrow(run, "turn int, doubt double, key long, id long, mark long")
    single = rows.groupBy("turn", "id").agg(F.min(F.struct("doubt", "key", "mark")).alias("row")).select("turn", "id", "row.*")
    place = F.row_number().over(Window.partitionBy("turn").orderBy("doubt", "key", "id"))
    listed = single.withColumn("place", place).where(F.col("place") <= most).collect()
    chosen: dict[int, list] = {at: [] for at in range(len(turns))}
    given: set[int] = set()
    for r in sorted(listed, key=lambda r: (r["turn"], r["place"])):
        if r["id"] not in given and len(chosen[r["turn"]]) < wanted[turns[r["turn"]][2]]:
            chosen[r["turn"]].append((r["id"], r["mark"]))
            given.add(r["id"])
    pairs = {pair for listed in chosen.values() for pair in listed}
    if not pairs:
        return {turn: [] for turn in turns}
    near = np.array(sorted(i for i, _ in pairs), np.int64)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            ids, marks = b.column(0).to_numpy(), b.column(1).to_numpy()
            at = []
            for i in np.flatnonzero(np.isin(ids, near)).tolist():
                pair = int(ids[i]), int(marks[i])
                if pair in pairs and pair not in seen:
                    seen.add(pair)
                    at.append(i)
            if at:
                yield b.take(pa.array(at))

    # A task gives a row once; rows that several tasks have are few, as only chosen ids are left.
    rows = pool.select("id", "mark", "text", "meta").mapInArrow(fetch, "id long, mark long, text binary, meta binary").dropDuplicates(["id", "mark"])
    known = {(r["id"], r["mark"]): r for r in rows.collect()}
    return {turns[at]: [(i, np.frombuffer(known[i, mark][turns[at][1]], np.float32).astype(np.float64)) for i, mark in pairs_of]
            for at, pairs_of in chosen.items()}


def _features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``id``, ``key``, ``mark`` (hashes of id and features), ``text``, ``meta``, ``labelled`` of each row with an id, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, *meta = (c.to_pylist() for c in b.columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([crc32(str(i).encode()) for i in ids], pa.int64()),
                 pa.array([text_features(t).tobytes() for t in texts], pa.binary()), pa.array([metadata_features(*x).tobytes() for x in zip(*meta)], pa.binary())],
                ["id", "key", "text", "meta"])

    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), *_input(docs))
    made = rows.mapInArrow(run, "id long, key long, text binary, meta binary")
    marked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("id")).distinct().withColumn("labelled", F.lit(True))
    made = made.join(marked, "id", "left")
    return staged(made.select("id", "key", F.xxhash64("text", "meta").alias("mark"), "text", "meta", F.coalesce("labelled", F.lit(False)).alias("labelled")), "features")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from ``labels`` (``doc_id``, ``quality`` 0 or 1) and ``docs`` (``doc_id`` and :data:`INPUT`).

    At most ``LABELLED`` labelled documents are used, the ones whose ids have the smallest hashes, and all others.
    A document with different labels counts by their mean. Null ids and labels are left out. Of labelled rows that share
    an id the one with the smallest features is used, so that the sample stays bounded.
    """
    features = _features(docs, labels)
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.when(F.avg("quality") >= 0.5, 1).otherwise(0).alias("label"))
    known = known.join(features.where("labelled").select("id").distinct(), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(LABELLED)
    rows = features.where("labelled").join(F.broadcast(known), "id")  # LABELLED rows at most
    got = rows.groupBy("id").agg(F.min(F.struct("label", "text", "meta")).alias("row")).select("id", "row.*").toPandas()
    got = got.assign(key=[crc32(str(i).encode()) for i in got["id"]]).sort_values(["key", "id"])
    text_x, meta_x = (np.array([np.frombuffer(x, np.float32) for x in got[c]], np.float64).reshape(len(got), n) for c, n in (("text", TEXT_SIZE), ("meta", META_SIZE)))
    pool = features.where("NOT labelled")
    return co_train(text_x, meta_x, got["label"].to_numpy().astype(float), lambda *state: _surest(pool, *state))


def _input(docs: DataFrame) -> list[Column]:
    types = ("string", "string", "string", "long")
    return [docs[c].cast(t).alias(f"in_{c}") for c, t in zip(INPUT, types)]


def scores(docs: DataFrame, model: Model) -> Column:
    """Column of ``docs``: struct of ``text_score``, ``meta_score``, ``score``, each 0 to 1; nulls count as missing."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("text_score double, meta_score double, score double")
    def run(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        whole = [None if pd.isna(n) else int(n) for n in n_chars]
        t = np.array([text_features(x) for x in text], np.float64).reshape(len(text), TEXT_SIZE)
        m = np.array([metadata_features(*x) for x in zip(lang, source, whole)], np.float64).reshape(len(text), META_SIZE)
        return pd.DataFrame(dict(zip(("text_score", "meta_score", "score"), shared.value.score(t, m))))

    return run(*_input(docs))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``text_score``, ``meta_score``, ``score``, ``keep`` per row of ``docs``; an empty table gives no rows."""
    out = docs.select(F.col("doc_id"), scores(docs, fit(docs, labels)).alias("s"))
    return out.select("doc_id", "s.text_score", "s.meta_score", "s.score", (F.col("s.score") >= KEEP).alias("keep"))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    return docs.where(scores(docs, fit(docs, labels))["score"] >= KEEP)
