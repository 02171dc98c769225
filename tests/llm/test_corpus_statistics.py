"""Phrases, toxicity and whitening against brute force, held-out accuracy and exact arithmetic."""

import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aeroline.llm import phrases, toxicity, whitening
from tests.conftest import SF_DIR
from tests.llm.test_operators import DOCS, empty_docs, odd_docs, rows


# 11: phrases.

def brute_phrases(docs, least, top=2000):
    counts, total = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    key = lang, tuple(words[i:i + k])
                    counts[key] = counts.get(key, 0) + 1
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        inside = any(
            other == lang and len(long) > len(words) and 100 * b >= 80 * a and any(long[i:i + len(words)] == words for i in range(len(long)))
            for (other, long), b in candidates.items())
        if not inside:
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        ((lang, rank, p.decode(), -a, x, y, total[lang], -s) for lang, found in out.items() for rank, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)), key=repr)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def corpus():
    texts = ["the old man and the sea, the old man", "The OLD man; a a a a a b", "x\ty z\x0bx y z\nx y z! é É", "to be or not to be to be or not", "a b"]
    docs = [(texts[i % 5], ("en", "de", None)[i % 3]) for i in range(40)]
    return docs + [(None, "en"), ("", "fr"), (" . , \t", "fr"), ("ab " * 5000, "en"), ("w1 w2 w3 w4 w5 " * 3, "en")]


@pytest.mark.parametrize("buckets", [64, 1 << 14])
@pytest.mark.parametrize("top", [3, 2000])
def test_phrases_equal_brute_force(spark, buckets, top):
    docs = corpus()
    frame = spark.createDataFrame(docs, "text string, lang string").withColumn("words", F.lit(1)).withColumn("f", F.lit("clash")).withColumn("rank", F.lit(0))
    assert rows(phrases.collocations(frame, least=3, top=top, buckets=buckets), *COLUMNS) == brute_phrases(docs, 3, top)


def test_phrase_counts_are_marginals_of_the_windows(spark):
    frame = spark.createDataFrame([("a b a b a", "en"), ("a b. a", "en")], "text string, lang string")
    got = {tuple(r["words"]): r["f"] for r in phrases.phrase_counts(frame, least=1).collect()}
    assert got == {(): 8, ("a",): 5, ("b",): 3, ("a", "b"): 3, ("b", "a"): 2, ("a", "b", "a"): 2, ("b", "a", "b"): 1, ("a", "b", "a", "b"): 1, ("b", "a", "b", "a"): 1}


def test_no_sort_or_shuffle_before_the_windows_are_counted(spark):
    frame = spark.createDataFrame([("a b", "en")], "text string, lang string")
    plan = phrases.windows(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window " not in plan


def test_phrases_of_odd_and_empty_tables(spark):
    odd = odd_docs(spark)
    docs = [(r["text"], r["lang"]) for r in odd.select("text", "lang").collect()]
    assert rows(phrases.collocations(odd, least=30), *COLUMNS) == brute_phrases(docs, 30)
    assert phrases.collocations(empty_docs(spark)).count() == 0


# 12: toxicity.

def test_word_classes_do_not_depend_on_chunks(monkeypatch):
    text = "Ein Wort, zwei Wörter; longestwordofall 3drei\n漢字 x" * 3
    whole = np.concatenate(list(toxicity.word_classes(text)))
    assert len(whole) == len(re.findall(r"[^\W\d_]+", text))
    pairs = np.concatenate(list(toxicity._pairs(text)))
    for size in (1, 3, 7, 20):
        monkeypatch.setattr(toxicity, "_CHUNK", size)
        assert np.concatenate(list(toxicity.word_classes(text))).tolist() == whole.tolist()
        assert np.concatenate(list(toxicity._pairs(text))).tolist() == pairs.tolist()
    assert pairs[0] // (toxicity.CLASSES + 1) == toxicity.START
    assert list(toxicity.word_classes("")) == [] and list(toxicity.word_classes("12 .,")) == []


def test_context_counts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "_BUFFER", 5)
    texts = [("you bad thing you bad", 1), ("a good thing", 0), ("a good thing", 0), ("bad day you good thing", 0), ("", 1), ("bad", 1)]
    seen = [set(), set()]
    for text, toxic in texts:
        words = [int(w) for part in toxicity.word_classes(text) for w in part]
        seen[toxic] |= set(zip([toxicity.START, *words], words))
    expected = {}
    for column, pairs in enumerate((seen[0], seen[1], seen[0] | seen[1])):
        for _, word in pairs:
            expected.setdefault(word, [0, 0, 0])[column] += 1
    frame = spark.createDataFrame(texts, "text string, toxic int").repartition(3)
    got = {r["word"]: [r["ordinary"], r["toxic"], r["shared"]] for r in toxicity.contexts(frame).collect()}
    assert got == expected


def test_log_ratios_are_kneser_ney_over_shared_counts():
    counts = np.zeros((3, 6))
    counts[:, :4] = [[40, 0, 3, 9], [2, 30, 1, 9], [41, 30, 4, 17]]
    got = toxicity.log_ratios(counts)
    shared = (counts[2] + 0.5) / (counts[2] + 0.5).sum()
    for w in range(6):
        p = []
        for own in counts[:2]:
            n = own.sum()
            left = sum(min(c, toxicity.DISCOUNT) for c in own)
            p.append((max(own[w] - toxicity.DISCOUNT, 0) + (left + toxicity.SHARED * n) * shared[w]) / (n * (1 + toxicity.SHARED)))
        assert got[w] == pytest.approx(np.log(p[1] / p[0]), rel=1e-5)
    assert got[1] > 0.5 and got[0] < -0.5


def test_pair_ratios_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "_BUFFER", 11)
    texts = [("you bad thing you bad day", 1)] * 7 + [("you good thing you bad bad", 0)] * 5 + [("good day", 0)] * 9 + [("day you", 1), ("", 0)]
    words = [([int(w) for part in toxicity.word_classes(text) for w in part], toxic) for text, toxic in texts]
    times = [Counter(), Counter()]
    for found, toxic in words:
        times[toxic].update(zip([toxicity.START, *found], found))
    frame = spark.createDataFrame(texts, "text string, toxic int").repartition(3)
    pairs = toxicity.pair_counts(frame)
    base = toxicity.CLASSES + 1
    assert {divmod(r["pair"], base): (r["ordinary"], r["toxic"]) for r in pairs.collect()} == {
        p: (times[0][p], times[1][p]) for p in times[0] | times[1]}

    random, discount, extra = np.random.default_rng(1), toxicity.DISCOUNT, toxicity.SHARED
    lower = [random.uniform(0.1, 1, toxicity.CLASSES) for _ in range(2)]
    vocabulary = {w for found, _ in words for w in found}
    for p in lower:
        p /= sum(p[w] for w in vocabulary)
    both = times[0] + times[1]
    expected = {}
    for v in {v for v, _ in both}:
        kept = {w: max(both[v, w] - discount, 0) for w in vocabulary}
        weight = sum(kept.values()) / sum(both[v, w] for w in vocabulary)
        if not weight:
            continue
        probability = []
        for kind in (0, 1):
            own = {w: times[kind][v, w] for w in vocabulary}
            total = sum(own.values())
            left = sum(min(n, discount) for n in own.values())
            shared = {w: kept[w] / sum(kept.values()) for w in vocabulary}
            upper = {w: (max(own[w] - discount, 0) + (left + extra * total) * shared[w]) / (total * (1 + extra)) if total else shared[w] for w in vocabulary}
            probability.append({w: weight * upper[w] + (1 - weight) * lower[kind][w] for w in vocabulary})
            assert sum(probability[-1].values()) == pytest.approx(1)
        expected |= {(v, w): np.log(probability[1][w] / probability[0][w]) for w in vocabulary if kept[w]}
    got = {divmod(r["pair"], base): r["ratio"] for r in toxicity.pair_ratios(pairs, lower).collect()}
    assert got == pytest.approx(expected, rel=1e-5, abs=1e-5) and 4 < len(got) < len(both)


def test_order_of_words_counts(spark):
    # The same words at the same rate in both kinds of text; only which one follows which tells them apart.
    one, two = "red dog blue cat red dog blue cat", "red cat blue dog red cat blue dog"
    texts = [(two if toxic else one, toxic, i % 4 != 0) for i in range(200) for toxic in (0, 1)]
    model = toxicity.fit(spark.createDataFrame(texts, "text string, toxic int, counted boolean"))
    known = [np.concatenate([model.log_ratio(p) for p in toxicity._pairs(text)]) for text in (one, two)]
    assert known[1][1::2].min() > 0.5 and known[0][1::2].max() < -0.5
    assert model.log_ratio(np.array([5 * (toxicity.CLASSES + 1) + 7])) == model.ratio[7]


def test_toxic_documents_of_the_held_out_part(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity.score(docs, labels.select("doc_id", "toxic"))
    held = got.where("held_out").join(docs.select("doc_id", "text"), "doc_id").toPandas()
    # The planted words of one language tell the truth, which labels do with some noise.
    planted = held.text.str.lower().str.count(r"\b(?:loser|idiot|pathetic|scum|worthless|moron|trash|clown|disgusting|stupid)\b") >= 2
    assert held.predicted[planted].mean() >= 0.97
    marked = labels.toPandas().set_index("doc_id").toxic
    clean = held[held.doc_id.map(marked) == 0]
    assert len(clean) > 1000 and clean.predicted.mean() <= 0.01
    assert held.score.between(0, 1).all()


def test_toxicity_learns_only_from_texts_and_labels_that_are_not_held_out(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "toxic")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    first, second = (rows(toxicity.score(d, m), "doc_id", "held_out", "score", "predicted") for d, m in ((docs, labels), (other, flipped)))
    assert first == second


def test_labels_join_alike_with_and_without_a_broadcast(spark, monkeypatch):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (5, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    first = rows(toxicity.labelled(odd_docs(spark), labels, F.lit(True)), "text", "toxic", "counted")
    monkeypatch.setattr(toxicity, "BROADCAST", 0)
    assert rows(toxicity.labelled(odd_docs(spark), labels, F.lit(True)), "text", "toxic", "counted") == first
    assert len(first) == 5 and sum(r[1] for r in first) == 3


def test_toxicity_of_odd_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (5, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    got = toxicity.score(odd_docs(spark), labels).collect()
    assert len(got) == 11 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    none = labels.where("false")
    assert {r["score"] for r in toxicity.score(odd_docs(spark), none).collect()} == {0.5}
    assert toxicity.score(empty_docs(spark), labels).count() == 0


# 13: whitening.

def brute_whitening(vectors, components):
    x = np.floor(1024 * np.array(vectors, float)).astype(int) + 100000
    n, sums = len(x), x.sum(axis=0)
    away = x - x.mean(axis=0)
    values, directions = np.linalg.eigh(away.T @ away / n)
    order = np.argsort(-values)[:components]
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    return n, deviation, away @ directions[:, order] / np.sqrt(values[order]), values[order] / values.sum()


@pytest.mark.parametrize("rank", [12, 3])
def test_whitening_equals_an_eigensolver(spark, rank):
    random = np.random.default_rng(rank)
    vectors = (random.normal(size=(300, rank)) * np.arange(1, rank + 1)) @ random.normal(size=(rank, 12))
    # Flooring would give small vectors full rank.
    vectors = np.round(vectors * 8) / 1024 * 128 if rank == 12 else np.c_[np.round(vectors[:, :3] * 64) / 64, np.full((300, 9), 0.25)]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").withColumn("n", F.lit("clash")).withColumn("x", F.lit(0))
    stored = [r["embedding"] for r in frame.orderBy("vec_id").collect()]
    n, deviation, expected, explained = brute_whitening(stored, 8)
    got = whitening.whitened(frame.repartition(5)).toPandas().sort_values(["component", "vec_id"])
    assert set(got.component) == set(range(1, min(8, rank) + 1)) and len(got) == 300 * min(8, rank)
    for component, part in got.groupby("component"):
        wanted = expected[:, component - 1]
        sign = np.sign(wanted @ part.whitened.to_numpy())
        assert np.allclose(part.whitened, sign * wanted, atol=1e-8)
        assert part.deviation.tolist() == deviation and set(part.n) == {n}
        assert np.allclose(part.explained, explained[component - 1], rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(0, 10**6))
def test_factor_and_rotations(size, rank, seed):
    random = np.random.default_rng(seed)
    base = random.normal(size=(size, min(size, rank))) * 10.0 ** random.integers(-3, 4, min(size, rank))
    matrix = base @ base.T
    factor = whitening.pivoted_cholesky(matrix)
    assert np.allclose(factor @ factor.T, matrix, atol=1e-10 * np.abs(matrix).max())
    turned = whitening.rotated(factor)
    assert np.allclose(turned @ turned.T, matrix, atol=1e-10 * np.abs(matrix).max())
    norms = np.sqrt((turned ** 2).sum(axis=0))
    cosines = (turned / norms).T @ (turned / norms)
    assert np.allclose(cosines, np.eye(len(norms)), atol=1e-12)


def test_deviations_stay_exact_and_are_null_beyond_a_long():
    x = np.array([[100_001, 99_999], [2**40, 5], [7, 2**50]], np.int64)
    for n in (3, 10**6, 10**12):
        sums = [int(s) * (n // 3) for s in x.sum(axis=0)]
        model = whitening.Whitening(n, sums, np.array([float(Fraction(s, n)) for s in sums]), np.eye(2), np.ones(2), np.ones(2))
        exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
        assert model.deviations(x) == [e if e < 2**63 else None for e in exact]
        assert model.deviations(x[:1] // 10**4) == [e if (e := sum((n * int(v) - s) ** 2 for v, s in zip(x[0] // 10**4, sums))) < 2**63 else None]


def test_whitening_of_odd_and_empty_tables(spark):
    schema = "vec_id long, embedding array<double>"
    good = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [2.0, -1.0]), (3, [1.0, 0.0])]
    odd = [(4, None), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1e300, 1.0]), (9, [1.0]), (10, [])]
    got = whitening.whitened(spark.createDataFrame(good + odd, schema)).collect()
    assert {r["n"] for r in got} == {4} and sorted((r["vec_id"] is None, r["vec_id"], r["component"]) for r in got if r["vec_id"]) == [
        (False, i, c) for i in (1, 3) for c in ((1, 1, 2, 2) if i == 1 else (1, 2))]
    assert len(got) == 8 and got[0]["identity_error"] < 1e-9
    for nothing in ([], odd[:4], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, [])]):
        assert whitening.whitened(spark.createDataFrame(nothing, schema)).count() == 0
