"""Exact substring deduplication: bytes covered by a string of 100 bytes that starts earlier elsewhere are removed.

How the work is dealt. Each window of ``WINDOW`` bytes picks one k-gram in it, its anchor, by hash (leftmost smallest);
equal windows pick the same anchor at the same offset. Neighbouring windows of one anchor form a context. So only
contexts with the same anchor can share a window, and contexts that are equal as a whole need no closer look: all but
the first are removed. Different contexts of one anchor meet in a shard, a text of a bounded size, where a suffix array
and its common prefixes give the classes of equal windows. An anchor that is in many contexts is dealt over several
shards; the classes of those are merged by binary search in their sorted fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroline.llm.suffixes import common_prefixes, suffix_array
from aeroline.session import staged

WINDOW = 100
GRAM = 32
#: Bytes of one shard's text, and of one round of anchor search.
SHARD, PIECE = 1 << 20, 1 << 21
#: An anchor with more contexts than that is spread over shards. Those in over ``SAMPLE_HOT`` contexts of a sample of
#: ``SAMPLE`` documents are known before, so that not even their places meet in one task. It only directs the work.
MANY, SAMPLE, SAMPLE_HOT = 2000, 5000, 24
NO_ID = (1 << 63) - 1
_BASE, _BACK = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_PLACE = (1 << 24) - 1
_SPAN = "doc long, mark int, lo long, hi long"
_FOUND = f"kind int, {_SPAN}, anchor long, print long"
REMOVED, CONTEXT, BIG, CLASS = range(4)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2^64."""
    size = max(PIECE, 2 * SHARD) + 4096
    up = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE, np.uint64)])
    return up, np.cumprod(np.r_[np.uint64(1), np.full(size, _BACK, np.uint64)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(data: np.ndarray) -> np.ndarray:
    return np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers()[0][: len(data)])]


def _hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each slice of the text."""
    return (sums[ends] - sums[starts]) * _powers()[1][starts]


def anchors(data: np.ndarray, borders: list[tuple[int, int]], window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Contexts of a text: first window, further windows, offset of the anchor, its hash, hash of the context.

    ``borders`` are the parts that windows do not cross.
    """
    sums, n = _sums(data), len(data)
    every = np.arange(max(0, n - gram + 1))
    hashes = _mixed(_hashes(sums, every, every + gram)) if n >= window else np.zeros(0, np.uint64)
    low = (hashes & ~np.uint64(_PLACE)) | every.astype(np.uint64)[: len(hashes)]
    width, grams = 1, window - gram + 1
    while width * 2 <= grams:
        low = np.minimum(low[:-width], low[width:]) if len(low) > width else low[:0]
        width *= 2
    if grams > width:
        low = np.minimum(low[: width - grams], low[grams - width:]) if len(low) > grams - width else low[:0]
    fits = np.zeros(len(low) + 1, bool)
    for lo, hi in borders:
        fits[lo:max(lo, hi - window + 1)] = True
    at = np.flatnonzero(fits[: len(low)])
    place = (low[at] & np.uint64(_PLACE)).astype(np.int64)
    fresh = np.r_[True, (at[1:] != at[:-1] + 1) | (place[1:] != place[:-1])] if len(at) else np.zeros(0, bool)
    first = at[fresh]
    last = at[np.r_[fresh[1:], True]] if len(at) else at
    offset = place[fresh] - first
    context = _hashes(sums, first, last + window) + (offset * 131 + last - first).astype(np.uint64) * np.uint64(_BASE)
    return first, last - first, offset, hashes[place[fresh]], _mixed(context)


def _text_mark(data: bytes) -> int:
    """Tells apart the texts of rows that share a doc_id."""
    return xxhash.xxh64_intdigest(data) & 0x1FFFF


def _packed(mark, start, more, offset):
    return mark << 46 | start << 14 | more << 7 | offset


def _contexts(batches: Iterator[pa.RecordBatch], window: int, gram: int, hot: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Rows (route, anchor, context, doc, loc) of whole texts. Of contexts that are equal within a batch only the first
    goes to its anchor; the others come out with context 0 as already known to be removed, on a route of their own."""
    names = ["route", "anchor", "context", "doc", "loc"]
    for batch in batches:
        gathered: list[tuple[np.ndarray, ...]] = []
        parts: list[tuple[int, int, int, int, bytes]] = []
        held = 0

        def run() -> None:
            data = np.frombuffer(b"".join(p[4] for p in parts), np.uint8)
            ends = np.cumsum([len(p[4]) for p in parts])
            starts = ends - [len(p[4]) for p in parts]
            first, more, offset, anchor, context = anchors(data, list(zip(starts.tolist(), ends.tolist())), window, gram)
            own = np.searchsorted(starts, first, "right") - 1
            doc, mark, base = (np.array([p[i] for p in parts], np.int64)[own] for i in (0, 1, 2))
            loc = _packed(mark, base + first - starts[own], more, offset)
            gathered.append((anchor.view(np.int64), context.view(np.int64), doc, loc))

        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = text.as_py().encode()
            if len(data) < window:
                continue
            mark = _text_mark(data)
            for at in range(0, len(data) - window + 1, PIECE // 2):  # a long text in pieces that overlap by a window
                piece = data[at:at + PIECE // 2 + window - 1]
                if parts and held + len(piece) > PIECE:
                    run()
                    parts, held = [], 0
                parts.append((doc, mark, at, 0, piece))
                held += len(piece)
        if parts:
            run()
        if not gathered:
            continue
        anchor, context, doc, loc = (np.concatenate(x) for x in zip(*gathered))
        order = np.lexsort((loc, doc, context, anchor))
        anchor, context, doc, loc = anchor[order], context[order], doc[order], loc[order]
        fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])]
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))
        again = (doc != doc[head]) | (loc != loc[head])
        route = np.where(again, _mixed(doc.view(np.uint64)).view(np.int64), anchor)
        if hot is not None and len(hot):
            place = np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)
            route = np.where(~again & (hot[place] == anchor), anchor ^ context, route)
        kept = again | fresh  # a row that is repeated as a whole counts once
        columns = (route, anchor, np.where(again, 0, context), doc, loc)
        for lo in range(0, len(kept), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(c[part][kept[part]]) for c in columns], names)


def _unpacked(loc: np.ndarray) -> tuple[np.ndarray, ...]:
    return (loc >> 46).astype(np.int32), (loc >> 14) & 0xFFFFFFFF, (loc >> 7) & 127, loc & 127


def _rows(kind, doc, mark, lo, hi, anchor=0, print_=0) -> Iterator[pa.RecordBatch]:
    n = len(doc)
    wide = [np.broadcast_to(np.asarray(x, t), n) for x, t in ((kind, np.int32), (doc, np.int64), (mark, np.int32), (lo, np.int64), (hi, np.int64), (anchor, np.int64), (print_, np.int64))]
    names = ["kind", "doc", "mark", "lo", "hi", "anchor", "print"]
    for at in range(0, n, 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c[at:at + (1 << 16)])) for c in wide], names)


def _collapse(batches: Iterator[pa.RecordBatch], window: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """All contexts of the anchors of one partition: repeated contexts are removed but for the first; of anchors with
    different contexts the first of each context is passed on."""
    got = [[c.to_numpy() for c in b.columns[1:]] for b in batches if b.num_rows]
    if not got:
        return
    anchor, context, doc, loc = (np.concatenate(x) for x in zip(*got))
    known = context == 0
    mark, start, more, _ = _unpacked(loc[known])
    yield from _rows(REMOVED, doc[known], mark, start, start + more + window)
    anchor, context, doc, loc = (x[~known] for x in (anchor, context, doc, loc))
    order = np.lexsort((loc, doc, context, anchor))
    anchor, context, doc, loc = anchor[order], context[order], doc[order], loc[order]
    if not len(anchor):
        return
    new_anchor = np.r_[True, anchor[1:] != anchor[:-1]]
    fresh = new_anchor | np.r_[True, context[1:] != context[:-1]]
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))
    again = (doc != doc[head]) | (loc != loc[head])
    mark, start, more, offset = _unpacked(loc)
    yield from _rows(REMOVED, doc[again], mark[again], start[again], (start + more + window)[again])
    group = np.cumsum(new_anchor) - 1
    contexts = np.bincount(group, fresh)[group]
    place = np.minimum(np.searchsorted(hot, anchor), max(0, len(hot) - 1))
    is_hot = hot[place] == anchor if len(hot) else np.zeros(len(anchor), bool)
    big = is_hot | (contexts > MANY)
    chosen = fresh & (is_hot | (contexts > 1))
    yield from _rows(np.where(big, BIG, CONTEXT)[chosen], doc[chosen], mark[chosen], start[chosen], (start + more)[chosen], anchor[chosen], context[chosen])


def _slices(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts that a text is asked for."""
    names = ["kind", "doc", "mark", "lo", "hi", "anchor", "route", "content"]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        held = 0
        for doc, text, asked in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            data = text.as_py().encode()
            own = _text_mark(data)
            for x in asked.as_py():
                if x["mark"] != own:
                    continue
                content = data[x["lo"]:x["hi"] + window]
                held += len(content)
                route = x["anchor"] ^ x["print"] if x["kind"] == BIG else x["anchor"]
                for column, value in zip(out, (x["kind"], doc, own, x["lo"], x["hi"], x["anchor"], route, content)):
                    column.append(value)
            if held > PIECE:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)
                out, held = [[] for _ in names], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)


def _shards(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Suffix arrays over the contexts of one partition, shard by shard."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    table = pa.Table.from_batches(got)
    anchor = table.column("anchor").to_numpy()
    order = np.lexsort((table.column("lo").to_numpy(), table.column("mark").to_numpy(), table.column("doc").to_numpy(), anchor))
    kind, doc, mark, lo, hi, anchor = (table.column(c).to_numpy()[order] for c in ("kind", "doc", "mark", "lo", "hi", "anchor"))
    content = table.column("content")
    sizes = hi - lo + window
    shard = np.cumsum(sizes) // SHARD
    fresh = np.r_[True, anchor[1:] != anchor[:-1]]
    heads = np.flatnonzero(fresh)
    tails = np.r_[heads[1:], len(anchor)] - 1
    # An anchor that fits goes whole into the shard of its first context.
    length = np.add.reduceat(sizes, heads)
    whole = np.repeat(length <= SHARD, tails - heads + 1)
    shard = np.where(whole, np.repeat(shard[heads], tails - heads + 1), shard)
    merged = (kind == BIG) | ~whole
    for own in np.split(np.arange(len(shard)), np.flatnonzero(np.diff(shard)) + 1):
        data = np.frombuffer(b"".join(content[int(order[i])].as_py() for i in own), np.uint8)
        yield from _classes(data, doc[own], mark[own], lo[own], hi[own], anchor[own], merged[own], window)


def _classes(data, doc, mark, lo, hi, anchor, merged, window) -> Iterator[pa.RecordBatch]:
    """Removed windows of one shard; for anchors that other shards have too, the first window of each class."""
    suffixes = suffix_array(data)
    same = common_prefixes(data, suffixes) >= window
    sizes = hi - lo + window
    ends = np.cumsum(sizes)
    starts = ends - sizes
    own = np.repeat(np.arange(len(doc)), sizes)
    begins = np.arange(len(data)) - starts[own] <= (hi - lo)[own]  # whole windows of a context
    names, document = np.unique(np.stack([doc, mark.astype(np.int64)]), axis=1, return_inverse=True)
    del names
    place = lo[own] + np.arange(len(data)) - starts[own]
    key = document.reshape(-1)[own] << 33 | place
    group = np.cumsum(~same)
    in_order = begins[suffixes]
    at, group = suffixes[in_order], group[in_order]
    if not len(at):
        return
    heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    first = np.repeat(np.minimum.reduceat(key[at], heads), np.diff(np.r_[heads, len(at)]))
    later = key[at] > first
    gone = np.sort(at[later])
    if len(gone):
        run = np.r_[True, (gone[1:] != gone[:-1] + 1) | (own[gone[1:]] != own[gone[:-1]])]
        a, b = gone[run], gone[np.r_[run[1:], True]]
        yield from _rows(REMOVED, doc[own[a]], mark[own[a]], place[a], place[b] + window)
    kept = at[~later & merged[own[at]]]
    if len(kept):
        prints = _mixed(_hashes(_sums(data), kept, kept + window)).view(np.int64)
        yield from _rows(CLASS, doc[own[kept]], mark[own[kept]], place[kept], place[kept] + window, anchor[own[kept]], prints)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of several shards: sorted by fingerprint, each looks up where its fingerprint starts; that one stays."""
    got = [[c.to_numpy() for c in b.columns] for b in batches if b.num_rows]
    if not got:
        return
    doc, mark, lo, hi, anchor, prints = (np.concatenate(x) for x in zip(*got))
    both = _mixed(prints.view(np.uint64) + np.uint64(_BASE) * anchor.view(np.uint64))
    order = np.lexsort((lo, mark, doc, both))
    doc, mark, lo, hi, both = doc[order], mark[order], lo[order], hi[order], both[order]
    first = np.searchsorted(both, both, "left")
    later = (doc != doc[first]) | (mark != mark[first]) | (lo != lo[first])
    out = [pa.array(c[later]) for c in (doc, mark, lo, hi)]
    if later.any():
        yield pa.RecordBatch.from_arrays(out, ["doc", "mark", "lo", "hi"])


def removed_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc``, ``mark``, ``lo``, ``hi``: spans of bytes to remove, overlapping, of ``docs`` (``doc``, ``text``)."""
    if not 0 < gram <= window or window - gram > 127:
        raise ValueError("an anchor lies in a window, which is at most 127 bytes longer")
    spark = docs.sparkSession
    rows = docs.select("doc", "text")
    schema = "route long, anchor long, context long, doc long, loc long"
    ids = docs.select(F.xxhash64("doc").alias("hash"))
    bound = ids.groupBy("hash").count().orderBy("hash").limit(SAMPLE).agg(F.max("hash")).first()[0]
    hot = np.zeros(0, np.int64)
    if bound is not None:
        sample = rows.where(F.xxhash64("doc") <= F.lit(bound)).mapInArrow(lambda b: _contexts(b, window, gram, None), schema)
        often = sample.where("context <> 0").groupBy("anchor").agg(F.count_distinct("context").alias("n")).where(F.col("n") > SAMPLE_HOT)
        hot = np.sort(np.array([r["anchor"] for r in often.select("anchor").collect()], np.int64))
    shared = spark.sparkContext.broadcast(hot)

    dealt = rows.mapInArrow(lambda b: _contexts(b, window, gram, shared.value), schema).repartition("route")
    found = staged(dealt.mapInArrow(lambda b: _collapse(b, window, shared.value), _FOUND), "repeats")
    asked = found.where(F.col("kind") != REMOVED).groupBy("doc").agg(
        F.collect_list(F.struct("kind", "mark", "lo", "hi", "anchor", "print")).alias("asked"))
    slices = rows.join(asked, "doc").select("doc", "text", "asked").mapInArrow(
        lambda b: _slices(b, window), f"kind int, {_SPAN}, anchor long, route long, content binary")
    classes = staged(slices.repartition("route").mapInArrow(lambda b: _shards(b, window), _FOUND), "repeat-classes")
    merged = classes.where(F.col("kind") == CLASS).select("doc", "mark", "lo", "hi", "anchor", "print").repartition(
        "anchor", "print").mapInArrow(_merge, _SPAN)
    span = ("doc", "mark", "lo", "hi")
    return found.where(F.col("kind") == REMOVED).select(*span).union(
        classes.where(F.col("kind") == REMOVED).select(*span)).union(merged)


def _kept(data: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Bytes removed, runs of them, and what stays."""
    pieces, removed, runs, end = [], 0, 0, 0
    for lo, hi in sorted(spans):
        if lo > end or not runs:
            pieces.append(data[end:lo])
            runs += 1
            removed += hi - lo
            end = hi
        elif hi > end:
            removed += hi - end
            end = hi
    pieces.append(data[end:])
    return removed, runs, b"".join(pieces)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part, out = batch.slice(at, 500), []
            for text, spans in zip(part.column(1), part.column(2)):
                data = text.as_py().encode()
                own = _text_mark(data)
                out.append((len(data), *_kept(data, [(s["lo"], s["hi"]) for s in spans.as_py() or [] if s["mark"] == own])))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())],
                ["doc", "n_bytes", "n_removed", "n_spans", "kept"])


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the bytes that stay) per row of ``docs`` (``doc_id``, ``text``).

    Removed is each byte covered by a string of ``window`` bytes that also starts earlier: in a document with a smaller
    doc_id, or earlier in the same one; overlaps count and texts are judged as they came. A null text is empty. A null
    doc_id comes after all others. Rows that share a doc_id come in the order of a hash of their text; rows that are
    equal as a whole count as one document and get the same result. Other columns are left behind.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    spans = removed_spans(rows, window, gram).groupBy("doc").agg(F.collect_list(F.struct("mark", "lo", "hi")).alias("spans"))
    out = rows.join(spans, "doc", "left").select("doc", "text", "spans").mapInArrow(
        _cut, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def cut_texts(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` with ``text`` cut as in :func:`without_repeats`, and all other columns as they are.

    What is left of a character that a cut goes through is dropped. A null text stays null.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    spans = removed_spans(docs.select(doc.alias("doc"), F.coalesce(F.col("text"), F.lit("")).alias("text")), window, gram)
    known = spans.groupBy("doc").agg(F.collect_list(F.struct("mark", "lo", "hi")).alias("spans"))

    @F.udf("string", useArrow=True)
    def cut(text: str | None, spans: list | None) -> str | None:
        if text is None or not spans:
            return text
        data = text.encode()
        own = _text_mark(data)
        return _kept(data, [(s["lo"], s["hi"]) for s in spans if s["mark"] == own])[2].decode(errors="ignore")

    whole = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"))
    joined = whole.join(known, "doc", "left")
    return joined.select(*[cut("row.text", "spans").alias("text") if c == "text" else F.col(f"row.{c}").alias(c) for c in docs.columns])
