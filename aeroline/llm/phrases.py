"""Collocations: counts of padded word windows, marginalised by ROLLUP to all shorter phrases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroline.session import staged

LONGEST = 4
LEAST = 30
TOP = 2000
UNKNOWN = "und"
#: Buckets of a sketch: about one for 16 characters of text, within these bounds (2 KB to 8 MB of bits).
SKETCH_BUCKETS = (1 << 14, 1 << 26)
_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]
_KEY = "struct<score: bigint, cut: int, l: bigint, r: bigint>"


def windows(docs: DataFrame, width: int = LONGEST) -> DataFrame:
    """``lang``, ``w1`` to ``w`` ``width``: one row per word of ``docs`` (``text``, ``lang``) with the words that follow it in its piece.

    The lead columns are the piece's own words moved up by one, two and so on, so no shuffle and no sort is needed for
    them. Behind the end of a piece they are padded with empty strings, which no word is.
    """
    upper, ends = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ".,;:!?\x0b\x0c\r"
    # All ends of pieces become line ends and tabs blanks, so that texts are cut at single signs and not by patterns.
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), upper + ends + "\t", upper.lower() + "\n" * len(ends) + " ")
    pieces = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.explode(F.split(text, "\n")).alias("piece"))
    listed = pieces.select("lang", F.array_remove(F.split("piece", " "), "").alias("words"))
    names = _WORDS[:width]
    lead = [F.col("words").alias("w1"), *[F.slice("words", i, F.size("words")).alias(name) for i, name in enumerate(names[1:], 2)]]
    rows = listed.where(F.size("words") > 0).select("lang", F.explode(F.arrays_zip(*lead)).alias("window"))
    return rows.select("lang", *[F.coalesce(F.col("window").getField(w), F.lit("")).alias(w) for w in names])


class Sketch:
    """Which phrases of ``size`` words may reach ``least`` occurrences, told by a bit per hash bucket.

    Counts of all occurrences are summed by bucket over the whole table. A bucket below ``least`` proves that every phrase
    in it is rarer; one that reaches it proves nothing. So results do not depend on the number of buckets, only the work
    saved does. The bits are one value of at most 8 MB, whatever the number of texts.
    """

    def __init__(self, rows: DataFrame, size: int, least: int, buckets: int):
        self.buckets = buckets
        bucket = self._bucket([F.col(w) for w in _WORDS[:size]])
        counted = rows.where(F.col(_WORDS[size - 1]) != "").groupBy(bucket.alias("bucket")).count().where(F.col("count") >= least)
        cells = counted.groupBy(F.shiftright("bucket", 6).alias("id")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(bucket & 63 as int))")).alias("bits"))
        every = rows.sparkSession.range(buckets >> 6).join(cells, "id", "left").select("id", F.coalesce("bits", F.lit(0)).alias("bits"))
        listed = every.agg(F.sort_array(F.collect_list(F.struct("id", "bits"))).alias("cells"))
        self.table = staged(listed.select(F.transform("cells", lambda c: c["bits"]).alias("bits")), "phrase-sketch")

    def _bucket(self, words: list[Column]) -> Column:
        return F.xxhash64(F.col("lang"), *words).bitwiseAND(F.lit(self.buckets - 1))

    def may(self, *words: str) -> Column:
        bucket = self._bucket([F.col(w) for w in words])
        cell = F.get(self.table.scalar(), F.shiftright(bucket, 6).cast("int"))
        return F.getbit(cell, bucket.bitwiseAND(F.lit(63)).cast("int")) == 1


def _buckets(docs: DataFrame) -> int:
    chars = docs.agg(F.sum(F.length(F.col("text").cast("string")))).first()[0] or 0
    low, high = SKETCH_BUCKETS
    return min(high, max(low, 1 << (chars // 16).bit_length()))


def _cut(docs: DataFrame, width: int, sketches: dict[int, Sketch]) -> DataFrame:
    """Windows of ``width`` words that end before the first word that closes a surely rare phrase of a size sketched."""
    rows = windows(docs, width)
    for size, sketch in sketches.items():
        for end in range(size, width + 1):
            inside = _WORDS[end - size:end]
            kept = reduce(Column.__and__, [F.col(w) != "" for w in inside]) & sketch.may(*inside)
            rows = rows.withColumn(_WORDS[end - 1], F.when(kept, F.col(_WORDS[end - 1])).otherwise(F.lit("")))
    return rows


def phrase_counts(docs: DataFrame, least: int = LEAST, buckets: int | None = None) -> DataFrame:
    """``lang``, ``words``, ``f``: all phrases of up to four words with at least ``least`` occurrences in their language.

    Rows with no words are the languages themselves, ``f`` their number of words. Overlapping occurrences count.

    Windows are counted once, padded to four words, and ROLLUP sums them to the phrases they begin with. Before that they
    are cut where sketches of pairs and of triples prove that a phrase is too rare: neither it nor a longer one is asked
    for, and every part of a frequent phrase is frequent itself.
    """
    buckets = buckets or _buckets(docs)
    sketches: dict[int, Sketch] = {}
    for size in (2, 3):
        sketches[size] = Sketch(_cut(docs, size, sketches), size, least, buckets)
    rows = _cut(docs, LONGEST, sketches)
    counted = rows.groupBy("lang", *_WORDS).agg(F.count(F.lit(1)).alias("times"))
    sums = counted.rollup("lang", *_WORDS).agg(F.sum("times").alias("f"))
    # What ROLLUP leaves out is NULL, padding is empty: a phrase ends at its last word, and that is none of the padding.
    words = F.filter(F.array(*_WORDS), lambda w: w.isNotNull())
    listed = sums.where(F.col("lang").isNotNull()).select("lang", words.alias("words"), "f")
    whole = ~F.array_contains("words", "")
    return listed.where(whole & ((F.col("f") >= least) | (F.size("words") == 0)))


def collocations(docs: DataFrame, least: int = LEAST, top: int | None = TOP, buckets: int | None = None) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's best phrases of two to four words.

    Texts (null: empty) are lower-cased in A-Z, cut at ``.,;:!?`` and line ends into pieces and those at blanks and tabs into
    words; a null language is ``und``. ``a`` counts a phrase, ``n`` all words of the language. A phrase scores
    floor(2000000 a / (l + r)) at its weakest cut into a first part (``l`` occurrences) and a rest (``r``), the earliest
    of equal ones. Phrases inside a longer one with at least 80 % of their occurrences are left out. Order is by score, a
    and phrase (bytes); ``top`` is the length of each list, None for all. Equal rows count as often as they occur, extra
    columns are left behind, tables without words give no rows.

    Parts are found by equality joins on the table of frequent phrases, which AQE splits at hot parts; the lists are cut
    before the shuffle by language.
    """
    known = staged(phrase_counts(docs, least, buckets), "phrases")
    phrases = known.where(F.size("words") > 0).select("lang", F.concat_ws(" ", "words").alias("phrase"), "words", "f")
    candidates = phrases.where(F.size("words") > 1)
    size = F.size("words")

    cuts = candidates.select("lang", "phrase", "words", "f", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "f", "cut", F.concat_ws(" ", F.slice("words", F.lit(1), F.col("cut"))).alias("first"),
        F.concat_ws(" ", F.slice("words", F.col("cut") + 1, size)).alias("rest"))
    of = phrases.select("lang", "phrase", "f")
    cuts = cuts.join(of.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(of.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    exact = "cast(cast(2000000 as decimal(7, 0)) * cast(f as decimal(20, 0)) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0))) as bigint)"
    scored = cuts.withColumn("score", F.expr(exact)).groupBy("lang", "phrase", "f").agg(
        F.min(F.struct("score", "cut", "l", "r").cast(_KEY)).alias("best"))

    parts = candidates.where(size > 2).select("f", "lang", "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("length"))
    parts = parts.select("f", "lang", "words", "length", F.explode(F.sequence(F.lit(1), size - F.col("length") + 1)).alias("start"))
    around = parts.groupBy("lang", F.concat_ws(" ", F.slice("words", F.col("start"), F.col("length"))).alias("phrase")).agg(
        F.max("f").alias("longer"))
    absorbed = F.expr("cast(longer as decimal(20, 0)) * 100 >= cast(f as decimal(20, 0)) * 80")
    left = scored.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~absorbed)

    ranked = left.select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "best.score").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")))
    kept = ranked if top is None else ranked.where(F.col("rank") <= top)
    totals = known.where(F.size("words") == 0).select("lang", F.col("f").alias("n"))
    return kept.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
