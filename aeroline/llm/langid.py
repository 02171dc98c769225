"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Counts travel in blocks of so many buckets, so that no row is large and sums spread over tasks.
BLOCK = 512
SMOOTHING = 0.5
UNKNOWN = "und"
_CHUNK = 1 << 20
#: Entries of the sparse count matrix that are scored at once.
_SLICE = 1 << 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a text in lower case; whatever is no letter is one blank. No letter: nothing.

    Long texts come in chunks. Each goes on from the last signs of the one before, so that the n-grams are those of the
    whole text however it is cut.
    """
    low, longest, size = text.lower(), max(ORDERS), len(text.lower())
    carry, last, letters, held = np.zeros(0, np.uint64), None, False, []
    for at in range(0, size, _CHUNK):
        codes = np.frombuffer(low[at:at + _CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(_letters()[codes], codes, 32)
        before = np.r_[codes[:1] if last is None else [last], codes[:-1]]
        kept = (codes != 32) | (before != 32)
        if last is None:
            kept[0] = True
        codes, last = codes[kept], codes[-1]
        letters = letters or bool((codes != 32).any())
        fresh = np.r_[[32] if at == 0 else [], codes, [32] if at + _CHUNK >= size else []].astype(np.uint64)
        whole, old = np.r_[carry, fresh], len(carry)
        out = []
        for n in ORDERS:
            own = whole[max(0, old - n + 1):]
            if len(own) < n:
                continue
            mixed = own[: len(own) - n + 1] + np.uint64(n)
            for k in range(1, n):
                mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + own[k: len(own) - n + 1 + k]
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            out.append((mixed >> np.uint64(49)).astype(np.int64))
        carry = whole[len(whole) - min(len(whole), longest - 1):]
        # Until a letter comes there are two blanks at most, and so a handful of n-grams.
        held.append(np.concatenate(out) if out else np.zeros(0, np.int64))
        if letters:
            yield np.concatenate(held)
            held = []


def counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``block``, ``counts`` (one long per bucket of the block) over all rows of ``docs`` (``text``, ``lang``)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                for part in buckets(text.as_py()):
                    own = seen.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    own += np.bincount(part, minlength=BUCKETS)
        for lang, own in seen.items():
            blocks = own.reshape(-1, BLOCK)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(blocks)), pa.array(range(len(blocks)), pa.int32()), pa.array(list(blocks), pa.list_(pa.int64()))],
                ["lang", "block", "counts"])

    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    partial = rows.mapInArrow(gather, "lang string, block int, counts array<bigint>")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            values = batch.column(2).flatten().to_numpy().reshape(-1, BLOCK)
            for lang, block, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), values):
                sums[lang, block] = sums.get((lang, block), 0) + own
        for (lang, block), own in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([block], pa.int32()), pa.array([own], pa.list_(pa.int64()))], ["lang", "block", "counts"])

    return partial.repartition("lang", "block").mapInArrow(total, partial.schema)


class Model:
    """Languages in order of code points, with the log probability of each bucket (buckets x languages); all have the same prior."""

    def __init__(self, langs: list[str], matrix: np.ndarray):
        self.langs = langs
        totals = matrix.sum(axis=1, keepdims=True)
        self.log = np.ascontiguousarray((np.log(matrix + SMOOTHING) - np.log(totals + SMOOTHING * BUCKETS)).T) if langs else matrix.T

    def predict_all(self, texts: Iterable[str | None]) -> list[tuple[str, float]]:
        """Language and its posterior per text; ``und`` and 0 for a text that is null or has no letter, or without languages.

        A batch of texts is a sparse matrix of n-gram counts: its entries, one per n-gram, text after text. They pick rows of
        the log-probability matrix, which are summed by text, in slices of bounded size.
        """
        totals, seen, entries, rows, size = [], [], [], [], 0

        def add() -> None:
            starts = np.cumsum([0, *map(len, entries[:-1])])
            sums = np.add.reduceat(self.log[np.concatenate(entries)], starts, axis=0)
            for row, total in zip(rows, sums):
                totals[row] += total

        for row, text in enumerate(texts):
            totals.append(np.zeros(len(self.langs)))
            seen.append(False)
            for part in buckets(text or ""):
                seen[row] = True
                for at in range(0, len(part), _SLICE):
                    entries.append(part[at:at + _SLICE])
                    rows.append(row)
                    size += len(entries[-1])
                    if size >= _SLICE:
                        add()
                        entries, rows, size = [], [], 0
        if entries:
            add()
        out = []
        for total, some in zip(totals, seen):
            if not some or not self.langs:
                out.append((UNKNOWN, 0.0))
                continue
            best = int(total.argmax())
            out.append((self.langs[best], float(1 / np.exp(total - total[best]).sum())))
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def fit(docs: DataFrame) -> Model:
    """The model of all rows of ``docs`` that have a ``text`` and a ``lang``.

    Counting is distributed and covers whole texts. The driver gets one matrix, languages by ``BUCKETS``, whatever the
    number of documents. All languages have the same prior.
    """
    rows = counts(docs).collect()
    langs = sorted({r["lang"] for r in rows})
    matrix = np.zeros((len(langs), BUCKETS))
    for r in rows:
        matrix[langs.index(r["lang"]), r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = r["counts"]
    kept = [i for i in range(len(langs)) if matrix[i].any()]
    return Model([langs[i] for i in kept], matrix[kept])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (posterior, 0 to 1) per row of ``docs`` (``doc_id``, ``text``).

    Only the text decides. Ties go to the language that comes first. Other columns are left behind; an empty table
    gives no rows, and without a learned language every row is ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = shared.value.predict_all(t.as_py() for t in batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id", folds: int = 5):
    """Column: whether the crc32 of the id as text leaves no rest; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(True))
