"""Each operator against brute force, the library it has to equal, or held-out accuracy."""

import hashlib
import json
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from aeroline.llm import ann, bpe, codes, langid, licenses, mixing, quality, repeats, simhash, wrappers
from aeroline.llm.graph import components, forest
from aeroline.llm.queries import QUERIES, bpe_vocabulary
from aeroline.llm.statements import STATEMENTS
from aeroline.llm.suffixes import common_prefixes, suffix_array
from tests.conftest import SF_DIR
from tests.oracle_check import compare, connect

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, an extra column that clashes with internal names."""
    long = " ".join(f"word{i % 977} by{i}" for i in range(60_000))
    rows = [
        (1, "same words in this small text here", "en", "a", 3), (1, "same words in this small text here", "en", "a", 3), (1, "another text of the same id", "en", "a", None),
        (2, None, None, None, None), (3, "", "en", "a", 0), (None, "text without an id", "en", None, 5), (4, "Éa ïo 漢字 😀 ok", None, "b", 2),
        (5, long, "en", "b", len(long)), (6, long, "en", "b", len(long)), (7, " \t\n ", "fr", "c", 1), (8, "x" * 70_000, "fr", "c", 70_000)]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.withColumn("doc", F.lit(7)).withColumn("size", F.lit("x")).withColumn("key", F.lit(1)).withColumns({n: F.lit(0) for n in ("fingerprint", "label", "of", "score", "times", "spans", "row")})


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# Graph and suffix arrays.

def test_components_equal_union_find(spark):
    random.seed(3)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(160)] + [(500, i) for i in range(501, 560)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    linked = {x for e in edges if e[0] != e[1] for x in e}
    found = dict(rows(components(spark.createDataFrame(edges, "x long, y long")), "node", "component"))
    assert found == {x: find(x) for x in linked}
    a, b = forest(*np.array(edges).T)
    assert {x: y for x, y in zip(a.tolist(), b.tolist())} == {x: find(x) for x in linked if find(x) != x}


@pytest.mark.parametrize("letters", [1, 2, 5, 256])
def test_suffix_array_and_prefixes(letters):
    for n in (0, 1, 2, 9, 200):
        data = np.random.default_rng(n).integers(0, letters, n).astype(np.uint8)
        text = data.tobytes()
        order = suffix_array(data)
        assert order.tolist() == sorted(range(n), key=lambda i: text[i:])
        for i, length in list(enumerate(common_prefixes(data, order).tolist()))[1:]:
            a, b = text[order[i - 1]:], text[order[i]:]
            assert a[:length] == b[:length] and a[length:length + 1] != b[length:length + 1]


# 1: nearest neighbours.

def vectors(spark):
    random_ = np.random.default_rng(5)
    points = random_.normal(size=(900, 8)) + 4 * random_.integers(0, 5, (900, 1))
    data = [(i, p.tolist()) for i, p in enumerate(points)] + [(1000 + i, points[7].tolist()) for i in range(60)]
    data += [(2000, None), (2001, [0.0] * 8), (2002, [None] * 8), (2003, [float("nan")] * 8), (2004, [1.0, float("inf")] * 4), (None, [1.0] * 8), (2005, [1.0] * 3)]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("leaf", F.lit("clash"))


def test_tree_search_recall_scores_and_ties(spark):
    frame = vectors(spark)
    data = {r["vec_id"]: np.array(r["embedding"]) for r in frame.collect() if r["vec_id"] is not None and r["vec_id"] < 2000}
    index = ann.Index(frame, leaf=24)
    found = {}
    for r in index.search(frame.where("vec_id % 20 = 0 OR vec_id >= 2000")).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["id"], r["score"])
    assert set(found) == {i for i in data if i % 20 == 0}
    hits = 0
    for query, got in found.items():
        exact = sorted((float(np.sqrt(((v - data[query]) ** 2).sum())), i) for i, v in data.items() if i != query)[:10]
        hits += len({i for _, i in exact} & {i for i, _ in got.values()})
        assert sorted(got) == list(range(1, 11))
        assert all(score == float(np.sqrt(((data[i] - data[query]) ** 2).sum())) for i, score in got.values())
        assert [got[k] for k in sorted(got)] == sorted(got.values(), key=lambda x: (x[1], x[0]))
    assert hits >= 0.9 * 10 * len(found)
    copies = [found[1000][k] for k in range(1, 11)]
    assert copies == [(7, 0.0)] + [(1000 + i, 0.0) for i in range(1, 10)]


def test_tree_search_splits_large_leaves_and_takes_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    index = ann.Index(vectors(spark), leaf=24)
    assert max(index.parts) > 1
    assert index.search(vectors(spark).where("vec_id = 1000")).count() == 10
    nothing = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert ann.Index(nothing).search(nothing).count() == 0


def test_tree_search_with_repeated_queries_and_other_lengths(spark, monkeypatch):
    random_ = np.random.default_rng(6)
    points = random_.normal(size=(60, 4))
    data = [(i, p.tolist()) for i, p in enumerate(points)]
    schema = "vec_id long, embedding array<double>"
    frame = spark.createDataFrame(data + data[:20], schema)
    asked = [(1, data[1][1])] * 3 + [(2, data[2][1]), (500, [1.0, 2.0]), (501, [3.0, 2.0]), (502, [0.0, 1.0])]
    for shares in (50_000, 1):
        monkeypatch.setattr(ann, "QUERIES", shares)
        found = {}
        for r in ann.Index(frame, leaf=200).search(spark.createDataFrame(asked, schema)).collect():
            found.setdefault(r["query_id"], []).append((r["rank"], r["id"]))
        assert set(found) == {1, 2}
        for q, got in found.items():
            exact = sorted((float(np.sqrt(((p - points[q]) ** 2).sum())), i) for i, p in enumerate(points) if i != q)[:10]
            assert sorted(got) == list(enumerate((i for _, i in exact), 1))


def test_sample_is_bounded_by_the_hash(spark):
    frame = spark.range(4000).selectExpr("id", "array(double(id)) AS v")
    got = ann.sampled(frame.unionByName(spark.createDataFrame([(7, [1.0])] * 3000, "id long, v array<double>")), 500)
    assert 150 < len(got) < 1000 and len({r["id"] for r in got}) == len(got) and [r["mark"] for r in got] == sorted(r["mark"] for r in got)
    assert len(ann.sampled(frame.limit(30), 500)) == 30


# 2: licenses.

def test_license_scan_finds_whole_changed_and_no_notices(spark):
    mit = licenses.TEMPLATES["MIT"]
    changed = mit.replace("free of charge, ", "").replace("merge, publish", "merge, quickly publish")
    texts = [(1, f"Intro words.\n{mit} End."), (2, changed), (3, "released   UNDER\nthe MIT license"), (4, "The rights of the copy of the text, and the use of it."), (5, None), (6, ""), (7, mit[: len(mit) // 2])]
    frame = spark.createDataFrame(texts + [texts[2]], "doc_id long, text string").withColumn("start", F.lit(0))
    found = licenses.scan(frame).collect()
    assert sorted((r["doc_id"], r["license"]) for r in found) == [(1, "MIT"), (2, "MIT"), (3, "MIT-line"), (3, "MIT-line")]
    by = {r["doc_id"]: r for r in found}
    text = texts[0][1][by[1]["start"]:by[1]["end"]]
    assert text == mit.rstrip(".") and by[1]["coverage"] == 1
    assert 0.9 < by[2]["coverage"] < 1
    assert licenses.scan(empty_docs(spark)).count() == 0


def test_license_lines_of_the_documents_are_all_found(spark):
    lines = {k: v for k, v in licenses.TEMPLATES.items() if k.endswith("-line")}
    docs = table(spark, "documents")
    wanted = [(r["doc_id"], k) for r in docs.collect() for k, v in lines.items() for _ in range(r["text"].count(v))]
    assert rows(licenses.scan(docs, lines), "doc_id", "license") == sorted(wanted, key=repr)


@pytest.mark.parametrize("text,name", [
    ("Released under the BSD License.", "BSD-line"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0-short"), ("Licensed under CC BY 4.0.", "CC-BY-4.0-short"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0-line"), ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0-line"),
    ("SPDX-License-Identifier: MIT-0", "MIT-0-spdx"), ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-spdx"), ("Released under the XYZ License.", None),
    ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0-short"), ("Licensed under CC BY 3.0.", None), ("This work is licensed under the GNU Free Documentation License, version 3.", None),
    ("Licensed under the Apache License, Version 1.1.", None), ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 International License.", None)])
def test_licenses_are_told_from_their_kin(text, name):
    index = licenses._index(tuple(licenses.TEMPLATES.items()))
    assert [m[0] for m in licenses.scan_text(f"Words before. {text} And words after it.", index, 0.8)] == ([name] if name else [])


def brute_licenses(text, coverage):
    """Every template against every window of the text by an unbanded alignment."""
    found = licenses.words(text)
    spans = [m.span() for m in re.finditer(r"[^\W_]+", text)]
    index = licenses._index(tuple(licenses.TEMPLATES.items()))
    out = []
    for t, own in enumerate(index.words):
        best = np.zeros((len(own) + 1, len(found) + 1), np.int32)
        for i in range(len(own) - 1, -1, -1):
            for j in range(len(found) - 1, -1, -1):
                best[i, j] = best[i + 1, j + 1] + 1 if own[i] == found[j] else max(best[i + 1, j], best[i, j + 1])
        if best[0, 0] < coverage * len(own):
            continue
        i = j = 0
        pairs = []
        while i < len(own) and j < len(found):
            if own[i] == found[j] and best[i, j] == best[i + 1, j + 1] + 1:
                pairs.append((i, j))
                i, j = i + 1, j + 1
            elif best[i, j + 1] == best[i, j]:
                j += 1
            else:
                i += 1
        if index.tells(t, pairs) and pairs[-1][1] - pairs[0][1] < len(own) + 2 * licenses.BAND:
            out.append((index.names[t], len(pairs), len(pairs) / len(own), spans[pairs[0][1]][0], spans[pairs[-1][1]][1]))
    return licenses._best(out)


def test_altered_licenses_equal_a_brute_force_aligner():
    random.seed(12)
    index = licenses._index(tuple(licenses.TEMPLATES.items()))
    whole = {n: t for n, t in licenses.TEMPLATES.items() if len(t) > 120}
    assert len(licenses.TEMPLATES) > 50 and len(whole) >= 14
    for name, text in whole.items():
        for _ in range(2):
            own = text.split()
            for _ in range(max(1, len(own) // 40)):
                own[random.randrange(len(own))] = random.choice(["zzz", "", "zzz yyy"])
            altered = f"lorem {'ipsum ' * random.randrange(5)}" + random.choice([" ", "\n * "]).join(own) + " dolor sit"
            altered = altered.upper() if random.random() < 0.3 else altered
            wanted, got = brute_licenses(altered, 0.8), licenses.scan_text(altered, index, 0.8)
            assert [m[:3] for m in got] == [m[:3] for m in wanted], name
            assert [m[0] for m in got] in ([name], []), name


def test_whole_licenses_are_named_right():
    index = licenses._index(tuple(licenses.TEMPLATES.items()))
    for name, text in licenses.TEMPLATES.items():
        assert [m[0] for m in licenses.scan_text(f"Some words. {text}\n\nOther words.", index, 0.8)] == [name]
    # Different notices in one text are all found.
    both = " and more words here and there ".join(licenses.TEMPLATES[n] for n in ("GPL-2.0-header", "MIT", "LGPL-3.0-header", "BSD-3-Clause"))
    assert [m[0] for m in licenses.scan_text(both, index, 0.8)] == ["GPL-2.0-header", "MIT", "LGPL-3.0-header", "BSD-3-Clause"]


# 3: SimHash.

def plain_simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    shingles = [words[i:i + 4] for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), seed=42) for s in shingles]
    return sum(1 << i for i in range(64) if sum(h >> i & 1 for h in hashes) * 2 > len(hashes))


def brute_components(marks):
    label = {i: i for i, _ in marks}
    while True:
        new = {i: min(label[j] for j, g in marks if (f ^ g).bit_count() <= 4) for i, f in marks}
        if new == label:
            return label
        label = new


def test_simhash_equals_brute_force(spark):
    docs = table(spark, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    marks = [(i, plain_simhash(t)) for i, t in texts.items()]
    assert {i: r["fingerprint"] & (1 << 64) - 1 for i, r in found.items()} == dict(marks)
    assert {i: r["component_id"] for i, r in found.items()} == brute_components(marks)


def test_links_of_random_fingerprints_are_complete(spark):
    random.seed(1)
    marks = {random.getrandbits(64) for _ in range(60)}
    marks |= {m ^ sum(1 << b for b in random.sample(range(64), random.randrange(1, 7))) for m in list(marks) for _ in range(3)}
    pairs = list(enumerate(sorted(marks)))
    signed = {i: m - (1 << 64) if m >> 63 else m for i, m in pairs}
    found = components(simhash.links(spark.createDataFrame([(m,) for m in signed.values()], "fingerprint long")))
    named = dict(rows(found, "node", "component"))
    groups = {}
    for i, m in signed.items():
        groups.setdefault(named.get(m, m), set()).add(i)
    wanted = {}
    for i, c in brute_components(pairs).items():
        wanted.setdefault(c, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


@pytest.mark.parametrize("distance", [0, 1, 4])
def test_large_groups_of_fingerprints_stay_whole(distance):
    rng = random.Random(3)
    centres = [rng.getrandbits(63) for _ in range(4)] + [rng.getrandbits(64) - (1 << 63) for _ in range(300)]
    marks = set(centres)
    for centre in centres[:4]:
        bits = rng.sample(range(63), 12)
        marks |= {centre ^ sum(1 << b for b in bits if rng.random() < 0.5) for _ in range(500)}
        marks |= {centre ^ sum(1 << b for b in rng.sample(range(63), 9)) for _ in range(60)}
    own = np.array(sorted(marks), np.int64)
    rng.shuffle(own)
    assert len(own) > simhash.DENSE
    few = np.array([1, 3, 1 << 40], np.int64)
    batch = simhash.pa.RecordBatch.from_arrays([np.r_[few, own], np.r_[np.full(3, 9), np.full(len(own), 7)]], ["fingerprint", "key"])
    got = [x for b in simhash._close(iter([batch]), distance) for x in zip(*(c.to_pylist() for c in b.columns))]
    near = np.bitwise_count((own[:, None] ^ own[None, :]).view(np.uint64)) <= distance
    low = np.arange(len(own))
    while True:
        new = np.where(near, low[None, :], len(own)).min(axis=1)
        if (new == low).all():
            break
        low = new
    nodes = {m: m for m in own.tolist()}

    def root(m):
        while nodes[m] != m:
            m = nodes[m]
        return m

    for a, b in got:
        if a in nodes:
            nodes[root(a)] = root(b)
    assert len({root(m) for m in nodes}) == len(set(low.tolist()))
    assert len({(root(m), label) for m, label in zip(own.tolist(), low.tolist())}) == len(set(low.tolist()))
    assert len(got) == len(own) - len(set(low.tolist())) + {0: 0, 1: 1, 4: 2}[distance]  # 1, 3 and 1 << 40


def test_simhash_of_odd_rows(spark):
    found = simhash.near_duplicates(odd_docs(spark)).collect()
    by = {r["doc_id"]: r for r in found}
    assert len(found) == 11 and by[None]["component_id"] is None
    assert by[2]["fingerprint"] == by[3]["fingerprint"] == by[7]["fingerprint"] == 0
    assert by[3]["component_id"] == by[7]["component_id"] == 2 and by[6]["component_id"] == 5
    kept = simhash.without_copies(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 1, 1, 2, 4, 5, 8]
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


# 4: BPE.

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(bpe_vocabulary())
    made.no_padding()
    made.no_truncation()
    return made


def test_bpe_equals_the_library(spark, library):
    docs = table(spark, "documents").select("doc_id", "text").union(odd_docs(spark).select("doc_id", "text"))
    texts = {hash((r["doc_id"], r["text"])): r["text"] for r in docs.collect()}
    wanted = []
    for text in [r["text"] for r in docs.collect()]:
        ids = library.encode(text or "", add_special_tokens=False).ids
        wanted.append((len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)))
    assert texts and rows(bpe.encode(docs, bpe_vocabulary()), "n_tokens", "ids", "decoded") == sorted(wanted, key=repr)
    assert bpe.encode(empty_docs(spark), bpe_vocabulary()).count() == 0


def test_bpe_of_odd_texts(library):
    vocabulary = bpe.vocabulary(bpe_vocabulary())
    random.seed(2)
    letters = "abcdefghij'sreΣσςİßÀé 　\u0085\n1²½漢字😀<>|%"
    texts = ["".join(random.choices(letters, k=random.randrange(60))) for _ in range(1500)]
    texts += ["a<|endoftext|>b<|startoftext|>", "a" * 4000, "".join(random.choices("abcdefgh", k=8000)), "ab" * 3000, "*" * 2000]
    for text in texts:
        assert list(vocabulary.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_words_are_read_from_their_end(library):
    vocabulary = bpe.Vocabulary(bpe_vocabulary())
    random.seed(8)
    words = ["".join(random.choice(letters) for _ in range(random.randrange(1, 33))) for letters in ("aeinrst", "aéßñ漢z", "ofthe") for _ in range(500)]
    for word in words:
        assert list(vocabulary.short(word)) == list(vocabulary.stream(vocabulary.symbols(word)))
    # Beginnings after which no token can follow are passed over.
    assert 0 < len(vocabulary.states) < 0.8 * len({w[:i] for w in (v.encode().decode("latin-1") for v in words) for i in range(1, len(w))})


def test_full_word_tables_keep_what_is_asked_for(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    known = bpe._Words(bpe.Vocabulary(bpe_vocabulary()), True)
    first = {w: known[w] for w in ("one", "wörd", "a")}
    assert known["other"] and set(known.older) == set(first)
    monkeypatch.setattr(known.of, "short", None)  # nothing of this is worked out again
    assert all(known[w] is value for w, value in first.items() if w != "a")
    assert first["wörd"][3] == "wörd " and set(known) == {"other", "one", "wörd"}


def test_bpe_of_any_code_point(library):
    """Texts of assigned, unassigned, private and newly assigned code points, marks and their orders."""
    vocabulary = bpe.vocabulary(bpe_vocabulary())
    random.seed(4)
    spans = [(0x20, 0x250), (0x250, 0xD800), (0xE000, 0x30000), (0x300, 0x370), (0x1AB0, 0x1B00), (0x30000, 0x110000)]
    for _ in range(600):
        text = "".join(chr(random.randrange(*random.choice(spans))) for _ in range(60))
        assert list(vocabulary.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_borders_by_spines_equal_the_merges():
    vocabulary = bpe.vocabulary(bpe_vocabulary())
    random.seed(6)
    tokens = [t for t in vocabulary.ids if vocabulary.reachable(t)]
    inner = [t for t in tokens if not t.endswith(vocabulary.end)]
    pairs = [(random.choice(inner), random.choice(tokens)) for _ in range(4000)]
    pairs += [(t[:i], t[i:]) for t in random.sample(tokens, 3000) for i in range(1, len(t) - len(vocabulary.end))]
    pairs += [(c * i, c * j) for c in "aehlmosxz!*" for i in range(1, 6) for j in range(1, 6)]
    seen = set()
    for left, right in pairs:
        if left in vocabulary.ids and right in vocabulary.ids:
            whole = vocabulary.merged(vocabulary.symbols_of(left) + vocabulary.symbols_of(right)) == [left, right]
            assert vocabulary.compatible(left, right) == whole
            seen.add(whole)
    assert seen == {True, False}


def test_readable_text_comes_from_the_ids(spark, library):
    docs = table(spark, "documents").select("doc_id", "text").union(odd_docs(spark).select("doc_id", "text"))
    vocabulary = bpe.vocabulary(bpe_vocabulary())
    coded = bpe.encode(docs, bpe_vocabulary(), readable=True).collect()
    assert coded and all(r["text"] == "".join(vocabulary.text(map(int, r["ids"].split()))) for r in coded)
    for r in coded:  # an exact round trip: the readable text has the same ids
        assert " ".join(map(str, library.encode(r["text"], add_special_tokens=False).ids)) == r["ids"]


def test_stream_emits_before_the_end():
    vocabulary = bpe.vocabulary(bpe_vocabulary())
    read = []

    def symbols():
        for i, c in enumerate("the" * 5000):
            read.append(i)
            yield c

    stream = vocabulary.stream(symbols())
    next(stream)
    assert len(read) < 4 * 256


def test_byte_to_text_machine():
    data = "aé漢😀z".encode() + b"\xff\xe2\x82A\xf0\x9f" + "ü".encode() + b"\xc3"
    machine = bpe.Utf8()
    assert "".join(machine.feed(bytes([b])) for b in data) + machine.flush() == data.decode(errors="replace")
    vocabulary = bpe.vocabulary(bpe_vocabulary())
    assert "".join(vocabulary.text(vocabulary.encode("Plain wörds 漢字"))) == "plain wörds 漢字 "


# 5: pages.

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav>
<div class="cookie-notice">We use cookies</div><main><article><h1>{title}</h1><p>Read &amp; learn</p><div class="ad">Buy</div><p><b>{a}<br>second  part<p>{b}</p><form><input>Send</form>
<ul><li>one<li>two</ul></article><section id="comments"><p>first comment of a reader that is long</p></section></main><aside>Side</aside><footer>&copy; me</footer></body></html>"""


def test_wrappers_extract_the_article(spark):
    pages = [(i, f"http://h.example/{i}", PAGE.format(title=f"Title {i}", a=f"First {i} text", b=f"Other {i} &lt;text&gt; " * (1 + i % 3))) for i in range(6)]
    pages += [(6, None, None), (7, "http://h.example/7", ""), (8, "x", "<p>alone"), (8, "x", "<p>alone"), (9, "http://h.example/9", "</div><b>broken <i>text")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))
    found = rows(wrappers.main_text(frame), "page_id", "text", "n_chars")
    assert len(found) == 11
    by = {i: t for i, t, _ in found}
    for i in range(6):
        other = " ".join([f"Other {i} <text>"] * (1 + i % 3))
        assert by[i] == f"Title {i}\nRead & learn\nFirst {i} text second part\n{other}\none\ntwo"
    assert by[6] == by[7] == "" and by[8] == "alone" and by[9] == "broken text"
    assert all(n == len(t) for _, t, n in found)
    assert wrappers.main_text(frame.limit(0)).count() == 0


def test_wrapper_is_a_union_free_expression():
    made = [wrappers._pattern(wrappers.parse(h)) for h in ("<div><p>Fix</p><p>a</p><p>b</p></div>", "<div><h2>x</h2><p>Fix</p></div>", "<div><p>c</p></div>")]
    merged = wrappers.merge(wrappers.merge(made[0], made[1]), made[2])
    assert wrappers.expression(merged) == "<div>(<h2>'x'</>)?(<p>#slot</>)+</>"


def test_line_of_the_template_is_left_out_unless_pages_are_copies():
    def rule(pages):
        made = wrappers._pattern(wrappers.parse(pages[0]))
        for page in pages[1:]:
            made = wrappers.merge(made, wrappers._pattern(wrappers.parse(page)))
        return wrappers.rules(made, len(pages))

    pages = [f"<article><h2>A title</h2><div>Printed here</div><p>text {i} of some length</p><p>and more {i}</p></article>" for i in range(4)]
    assert rule(pages) == {"path": ["article"], "fixed": ["Printed here"]}
    assert wrappers.extract(pages[1], rule(pages)) == "A title\ntext 1 of some length\nand more 1"
    assert rule(pages[:2])["fixed"] == []
    assert rule(["<article><h1>Head</h1><div>the whole text</div></article>"] * 4)["fixed"] == []


def test_deeply_nested_pages():
    for n in (100, 5000):
        menu = "<nav>" + "<div><a>" * n + "left out" + "</a></div>" * n + "</nav>"
        page = "<article>" + "<div>" * n + f"<p>Kept <b>text</b>,<br>whole.</p>{menu}<p>More.</p>" + "end</div>" * n + "</article>"
        assert wrappers.extract(page, None) == "Kept text, whole.\nMore.\n" + "\n".join(["end"] * n)
    assert wrappers.extract("<article><p>One" + "<b>" * 5000 + " two</p></article>", None) == "One two"
    known = wrappers.merge(*(wrappers._pattern(wrappers.parse("<div>" * 5000 + f"<p>{t}")) for t in "ab"))
    assert wrappers.rules(json.loads(json.dumps(known)), 2)["path"]


def test_wrappers_stay_bounded_and_broken_markup_is_quick():
    rng, known, pages = random.Random(1), None, []
    for i in range(300):
        tags = [rng.choice(["h2", "p", "p", "ul", "pre", f"div class={''.join(rng.choices('abcdefgh', k=5))}"]) for _ in range(rng.randrange(5, 90))]
        pages.append("<body><article>" + "".join(f"<{t}>t{k}</{t[:3].strip()}>" for k, t in enumerate(tags)) + "</article></body>")
        own = wrappers._pattern(wrappers.parse(pages[-1]))
        known = own if known is None else wrappers.merge(known, own)
    assert len(json.dumps(known)) < 20_000 and wrappers.expression(known).count("(") > 2
    rule = wrappers.rules(known, len(pages))
    assert rule == {"path": ["body", "article"], "fixed": []}
    assert wrappers.extract(pages[0], rule).split("\n") == [f"t{k}" for k in range(pages[0].count(">t"))]
    assert wrappers.extract("<p>x</p>" + "<a " * 200_000, None).startswith("x\n<a <a")
    assert wrappers.extract("<p>one<!-- x > y", None) == "one"
    assert wrappers.extract("<p>one <!-- x --> two<!-- a > b <p>c", None) == "one two"
    assert wrappers.extract("<p>1 > 0 <b <!-- end", None) == "1 > 0 <b"


@pytest.mark.parametrize("page", [
    '<body><div class="page has-sidebar"><div class="sidebar">Side {i}.</div><article><p>{text}</p></article></div></body>',
    '<body><div class="sidebar">Side {i}.</div><div id="content" class="no-comments"><h1>{i}</h1><p>{text}</p></div></body>',
    '<body><div class="ad">Buy {i}.</div><section class="post share-enabled"><main><p>{text}</p></main></section></body>',
    '<body><article><div class="widget-text"><p>{text}</p></div><div class="share">Send {i}.</div></article></body>',
    '<body><div class="layout skip-ads"><div class="widget"><p>{text}</p></div></div><div class="related">See {i}.</div></body>'])
def test_containers_with_words_of_the_list_are_not_around(page):
    texts = [f"Text {i} that is long enough to be the main text of its page, number {i * 7}." for i in range(5)]
    pages = [page.format(i=i, text=t) for i, t in enumerate(texts)]
    known = None
    for n, p in enumerate(pages, 1):
        own = wrappers._pattern(wrappers.parse(p))
        known = own if known is None else wrappers.merge(known, own)
    rule = wrappers.rules(json.loads(json.dumps(known)), len(pages))
    for p, t in zip(pages, texts):
        for got in (wrappers.extract(p, rule), wrappers.extract(p, None)):
            assert got.split("\n")[-1] == t and not re.search("Side|Buy|Send|See", got)


def test_lists_of_comments_and_repeated_notices_are_around():
    comments = "".join(f'<li><article class="comment"><p>A very long opinion on the text, number {k}.</p></article></li>' for k in range(40))
    notice = '<div class="cookie-notice"><p>' + "We use small files. " * 20 + "</p></div>"
    pages = [f'<body>{notice}<div class="page no-sidebar"><article><p>Short text {i}.</p></article><div class="comments"><ol>{comments}</ol></div></div></body>' for i in range(4)]
    known = None
    for p in pages:
        own = wrappers._pattern(wrappers.parse(p))
        known = own if known is None else wrappers.merge(known, own)
    assert [wrappers.extract(p, wrappers.rules(known, 4)) for p in pages] == [f"Short text {i}." for i in range(4)]
    deep = '<div class="ad">' * 5000 + "x" + "</div>" * 5000
    assert wrappers.extract(f"<article><p>Kept.</p>{deep}</article>", None) == "Kept."


def test_pages_of_the_table(spark):
    import html

    for r in wrappers.main_text(table(spark, "pages")).join(table(spark, "pages").select("page_id", "html"), "page_id").collect():
        article = re.search("<article>(.*?)</article>", r["html"], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)[^>]*>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b)


def test_words_of_a_sentence_are_not_taken_out_by_their_class():
    page = ("<html><body><article><h1>Title of it</h1><p>The long <span class='related'>word &amp; <b>more</b></span> stays in <em>the <i id='share'>text</i></em> <u><i class='search'>found</i></u>.</p>"
            "<p><span class='share'>Share this</span> <a class='comments' href='#'>3 comments</a></p><p>Another paragraph of the text, with words.</p></article></body></html>")
    assert wrappers.extract(page, None) == "Title of it\nThe long word & more stays in the text found.\nAnother paragraph of the text, with words."


# 6: quality.

def test_quality_held_out_accuracy_and_odd_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    known = labels.where("doc_id % 3 <> 0")
    scored = quality.score(docs, known).join(labels.where("doc_id % 3 = 0"), "doc_id")
    got = [(r["keep"], r["quality"] == 1) for r in scored.collect()]
    assert len(got) > 80 and sum(a == b for a, b in got) >= 0.97 * len(got)
    assert quality.fit(docs, known).passed_on > 0
    again = docs.union(docs.where("doc_id % 2 = 0")).union(docs.where("doc_id = 1"))
    assert (quality.fit(again, known).combine == quality.fit(docs, known).combine).all()
    odd = odd_docs(spark)
    assert quality.score(odd, labels).count() == 11
    kept = quality.good(odd, spark.createDataFrame([(1, 1), (None, 0), (3, None)], "doc_id long, quality int"))
    assert kept.columns == odd.columns and kept.count() == 11  # nothing to tell classes apart
    assert quality.score(empty_docs(spark), labels).count() == 0
    assert quality.score(docs, labels.limit(0)).where("keep").count() == docs.count()


def test_all_unlabelled_documents_take_part_in_co_training(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    known = labels.where("doc_id % 3 <> 0")
    first = docs.join(labels, "doc_id", "left_anti").orderBy(F.xxhash64("doc_id")).limit(1)
    copies = first.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(8000)))).drop("n")
    once, often = quality.fit(docs, known), quality.fit(docs.union(copies), known)
    assert often.passed_on == once.passed_on > 1 and (often.combine == once.combine).all()


def test_surest_documents_are_those_of_all(spark):
    docs = spark.range(12_000).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.lit("ab c"), (F.col("id") % 7).cast("int")), F.col("id").cast("string")).alias("text"),
        F.lit("en").alias("lang"), F.lit("a").alias("source"), (F.col("id") * 3).alias("n_chars"))
    features = quality._features(docs, spark.createDataFrame([(5, 1)], "doc_id long, quality int"))
    got = {r["id"]: r for r in features.collect()}
    assert len(got) == 12_000 and [i for i, r in got.items() if r["labelled"]] == [5]
    random = np.random.default_rng(1)
    views = {k: quality.View(np.zeros(n), np.ones(n), random.normal(size=n + 1) * 9) for k, n in (("text", quality.TEXT_SIZE), ("meta", quality.META_SIZE))}
    taken, wanted = set(range(0, 12_000, 5)) - {5}, {1: 60, 0: 40}
    found = quality._surest(features.where("NOT labelled"), views, wanted, set(taken))
    for (teacher, learner, label), chosen in found.items():
        free = [i for i in got if i not in taken and i != 5]
        margin = views[teacher].margin(np.array([np.frombuffer(got[i][teacher], np.float32) for i in free], np.float64))
        certainty = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
        certainty = certainty if label else 1 - certainty
        order = sorted((j for j in range(len(free)) if certainty[j] >= quality.SURE), key=lambda j: -certainty[j])
        assert len(chosen) == min(wanted[label], len(order))
        if chosen:
            at = dict(zip(free, certainty))
            assert np.allclose([at[i] for i, _ in chosen], [certainty[j] for j in order[:len(chosen)]], atol=1e-9)
            assert all((x == np.frombuffer(got[i][learner], np.float32)).all() for i, x in chosen)
        taken |= {i for i, _ in chosen}
    assert sum(map(len, found.values())) >= 100


def test_documents_whose_label_is_null_take_part_as_unlabelled(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("quality")).alias("quality"))
    features = quality._features(docs, labels)
    known = {r["doc_id"] for r in labels.where("quality IS NOT NULL").collect()}
    assert {r["id"] for r in features.where("labelled").collect()} == known & {r["doc_id"] for r in docs.collect()}
    assert features.where("NOT labelled").count() == docs.count() - features.where("labelled").count()


# 7: mixing.

def test_mixing_meets_targets(spark):
    rng = random.Random(4)
    data = [(i, " ".join(["w"] * rng.randrange(1, 30)), None if i % 50 == 0 else rng.choice("abcdZé"), None, None) for i in range(4000)]
    mixed = mixing.mix(spark.createDataFrame([(a, t, None, s, None) for a, t, s, *_ in data], DOCS)).collect()
    by = {}
    for r in mixed:
        own = by.setdefault(r["source"], [r["source_size"], r["target"], 0, 0])
        own[2] += r["taken"]
        own[3] += r["size"]
        assert r["taken"] in (r["size"] * k for k in range(4))
    total = sum(v[0] for v in by.values())
    assert sum(v[1] for v in by.values()) == pytest.approx(total)
    assert all(size == seen and target <= 3 * size + 1e-9 and abs(taken - target) <= 30 for size, target, taken, seen in by.values())
    levels, caps = set(), 0
    for place, source in enumerate(sorted((s for s in by if s is not None)) + [None]):
        weight = 1 + place % 3
        caps += by[source][1] == 3 * by[source][0]
        if by[source][1] < 3 * by[source][0]:
            levels.add(round(by[source][1] / weight, 6))
    assert len(levels) == 1 and caps >= 1


def test_mixing_of_odd_rows(spark):
    mixed = mixing.mix(odd_docs(spark))
    assert mixed.count() == 11
    assert rows(mixed, "doc_id", "taken") == rows(mixing.mix(odd_docs(spark)), "doc_id", "taken")
    again = mixing.repeated(odd_docs(spark))
    assert again.columns == odd_docs(spark).columns
    assert mixing.mix(empty_docs(spark)).count() == 0


# 8: languages.

def test_language_held_out_accuracy_and_odd_rows(spark):
    docs = table(spark, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    got = langid.predict(docs.where(langid.held_out()), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 20 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    odd = langid.predict(odd_docs(spark), model).collect()
    assert all(0 <= r["score"] <= 1 for r in odd)
    assert {r["doc_id"] for r in odd if r["lang_pred"] == "und"} == {2, 3, 7}
    assert langid.predict(odd_docs(spark), langid.fit(empty_docs(spark))).where("lang_pred = 'und'").count() == 11
    assert langid.predict(empty_docs(spark), model).count() == 0


def test_language_counts_are_those_of_all_texts(spark, monkeypatch):
    model = langid.fit(odd_docs(spark))
    assert model.langs == ["en", "fr"]
    plain = {}
    for r in odd_docs(spark).collect():
        if r["text"] is not None and r["lang"] is not None:
            for place, n in plain_buckets(r["text"]).items():
                plain[r["lang"], place] = plain.get((r["lang"], place), 0) + n
    found = {(r["lang"], r["block"] * langid.BLOCK + i): n for r in langid.counts(odd_docs(spark)).collect() for i, n in enumerate(r["counts"]) if n}
    assert found == plain
    monkeypatch.setattr(langid, "_CHUNK", 7)
    short = [np.bincount(np.concatenate(list(langid.buckets("abc defg hij klm"))), minlength=langid.BUCKETS)]
    assert short[0].sum() > 0


def plain_buckets(text):
    """Counts of buckets, n-gram by n-gram in Python integers."""
    signs = [c if c.isalpha() else " " for c in text.lower()]
    signs = [c for i, c in enumerate(signs) if i == 0 or c != " " or signs[i - 1] != " "]
    if not any(c != " " for c in signs):
        return {}
    signs, out, mask = [" ", *signs, " "], {}, (1 << 64) - 1
    for n in langid.ORDERS:
        for i in range(len(signs) - n + 1):
            mixed = ord(signs[i]) + n
            for c in signs[i + 1:i + n]:
                mixed = (mixed * 0x9E3779B97F4A7C15 + ord(c)) & mask
            mixed ^= mixed >> 29
            place = (mixed * 0xBF58476D1CE4E5B9 & mask) >> 49
            out[place] = out.get(place, 0) + 1
    return out


@pytest.mark.parametrize("text", ["", "a", " ", "  a", "a  ", "1 2 3", "....", "abc defg  hij", " \t\n Ünï 漢字 42 x", "..... a ..... b .....", "ΑΣ ΣΑΣ. 12İx" * 3, "word " * 40])
def test_n_grams_do_not_depend_on_chunks(monkeypatch, text):
    wanted = plain_buckets(text)
    for chunk in (1, 2, 3, 5, 8, 1 << 20):
        monkeypatch.setattr(langid, "_CHUNK", chunk)
        got = np.concatenate([np.zeros(0, np.int64), *langid.buckets(text)])
        assert {int(k): int(n) for k, n in zip(*np.unique(got, return_counts=True))} == wanted


def test_batches_of_texts_score_as_single_ones(monkeypatch):
    rng = np.random.default_rng(4)
    model = langid.Model(["a", "b", "c"], rng.integers(0, 9, (3, langid.BUCKETS)).astype(float))
    texts = ["one two", None, "", "three " * 30, "12", "four five six", "x"]
    singles = []
    for text in texts:
        total = sum((n * model.log[place] for place, n in plain_buckets(text or "").items()), np.zeros(3))
        singles.append((model.langs[int(total.argmax())], 1 / np.exp(total - total.max()).sum()) if total.any() else (langid.UNKNOWN, 0.0))
    for size in (1, 5, 64, 1 << 18):
        monkeypatch.setattr(langid, "_SLICE", size)
        got = model.predict_all(texts)
        assert [g[0] for g in got] == [s[0] for s in singles] and np.allclose([g[1] for g in got], [s[1] for s in singles])
    assert langid.Model([], np.zeros((0, langid.BUCKETS))).predict("abc") == (langid.UNKNOWN, 0.0)


# 9: repeats.

def brute_cut(docs):
    """Documents in order; a window is removed if its bytes were there before."""
    seen, out = set(), {}
    for doc, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            window = data[i:i + 100]
            if window in seen:
                gone[i:i + 100] = True
            seen.add(window)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out[doc] = (len(data), int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(data) else 0, kept)
    return out


def passages():
    rng = random.Random(9)

    def prose(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé    ") for _ in range(n))

    common, line = prose(260), prose(97)
    docs = [(i, prose(rng.randrange(0, 500)) + rng.choice([common, line, common[:130], ""]) + prose(rng.randrange(0, 300))) for i in range(120)]
    docs += [(200, "ab" * 300), (201, "x" * 400), (202, prose(300) * 3), (203, docs[5][1]), (204, None), (205, "short"), (206, "y" + docs[6][1][3:])]
    return docs


@pytest.mark.parametrize("limits", [{}, {"SHARD": 2000, "MANY": 5, "PIECE": 3000}, {"MANY": 3, "SAMPLE_HOT": 1}])
def test_repeats_equal_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(repeats, name, value)
    docs = passages()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in repeats.without_repeats(frame).collect()}
    wanted = brute_cut(docs)
    assert found == wanted
    assert sum(v[1] for v in wanted.values()) > 10_000


def test_repeats_of_the_table_and_odd_rows(spark):
    docs = table(spark, "documents")
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in repeats.without_repeats(docs).collect()}
    assert found == brute_cut(sorted((r["doc_id"], r["text"]) for r in docs.collect()))
    odd = repeats.without_repeats(odd_docs(spark)).collect()
    assert len(odd) == 11
    assert next(r for r in odd if r["doc_id"] == 6)["n_removed"] == next(r for r in odd if r["doc_id"] == 6)["n_bytes"]
    cut = repeats.cut_texts(odd_docs(spark))
    assert cut.columns == odd_docs(spark).columns and cut.where("text IS NULL").count() == 1
    assert repeats.without_repeats(empty_docs(spark)).count() == 0


# 10: codes.

@pytest.mark.parametrize("segments", [None, 4])
def test_code_search_is_exact(spark, monkeypatch, segments):
    monkeypatch.setattr(codes, "BLOCK", 20)
    random.seed(8)
    base = [random.getrandbits(64) for _ in range(12)]
    data = [(i, random.choice(base) ^ sum(1 << b for b in random.sample(range(64), random.randrange(0, 9)))) for i in range(500)]
    data += [(600 + i, base[0]) for i in range(40)] + [(700, random.getrandbits(64)), (3, base[1])]
    signed = [(i, c - (1 << 64) if c >> 63 else c) for i, c in data]
    frame = spark.createDataFrame([*signed, (None, 5), (9, None)], "id long, code long").withColumn("key", F.lit("clash"))
    queries = frame.where("id % 25 = 0 OR id = 700")
    found = {}
    for r in codes.search(frame, queries, segments=segments).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["distance"], r["id"])
    for query, code in data:
        if query % 25 == 0 or query == 700:
            wanted = sorted(((code ^ c).bit_count(), i) for i, c in data if i != query)[:10]
            assert [found[query][k] for k in range(1, 11)] == wanted
    few = frame.where("id IN (1, 2)")
    assert codes.search(few, few).count() == 2
    assert codes.search(frame.limit(0), frame.limit(0)).count() == 0


def test_sign_codes_of_odd_vectors(spark):
    data = [(1, [1.0] * 70), (2, [-1.0, 2.0, None, float("nan")]), (3, None), (None, [1.0]), (4, [])]
    assert rows(codes.sign_codes(spark.createDataFrame(data, "vec_id long, embedding array<double>")), "id", "code") == [(1, [-1, 63]), (2, [2, 0]), (4, [0, 0])]
    assert rows(codes.sign_codes(spark.createDataFrame(data[1:], "vec_id long, embedding array<double>")), "id", "code") == [(2, 2), (4, 0)]


@pytest.mark.parametrize("segments", [1, 2, 3, 8])
def test_codes_beyond_64_bits_and_repeated_queries(spark, segments):
    random.seed(segments)
    base = [[random.choice([-1.0, 1.0]) for _ in range(70)] for _ in range(5)]
    near = lambda v: [-x if random.random() < 0.03 else x for x in v]
    data = [(i, near(random.choice(base))) for i in range(60)]
    frame = codes.sign_codes(spark.createDataFrame(data + data[:9], "vec_id long, embedding array<double>"))
    # A probe of a wide segment has very many neighbours; close codes end the search long before that.
    queries = frame.where("id % 5 = 0").limit(6 if segments < 3 else 99)
    asked = {r["id"] for r in queries.collect()}
    got = rows(codes.search(frame, queries.union(queries), k=3, segments=segments), "query_id", "rank", "id", "distance") if segments > 1 else []
    wanted = []
    for q in asked if segments > 1 else ():
        ranked = sorted((sum((a > 0) != (b > 0) for a, b in zip(v, data[q][1])), i) for i, v in data if i != q)[:3]
        wanted += [(q, k, i, d) for k, (d, i) in enumerate(ranked, 1)]
    assert got == sorted(wanted, key=repr)
    assert [sum(w for _, w in codes._cuts(n)) for n in (1, 2, 3, 4, 8)] == [64] * 5


# Queries.

@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_sql(spark, name):
    problem, _, _ = compare(spark, connect(SF_DIR), name, QUERIES[name], STATEMENTS[name], SF_DIR)
    assert problem is None


def test_digests_are_those_of_the_operators(spark, library):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    for r in QUERIES["op4_bpe"](spark, SF_DIR).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    marks = {i: plain_simhash(t) for i, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in QUERIES["op3_simhash"](spark, SF_DIR).collect()} == {i: f"{m:016x}" for i, m in marks.items()}
