"""The pipeline's stages against brute force, each on its own input."""

import corpus_pipeline
from aeroline.llm import bpe, mixing
from aeroline.llm.queries import bpe_vocabulary
from aeroline.session import staged
from tests.conftest import SF_DIR
from tests.llm.test_operators import brute_components, brute_cut, odd_docs, plain_simhash

SF = SF_DIR.replace("0.001", "0.01")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = [function for _, function in corpus_pipeline.STAGES]
    good = staged(stage[0](spark, docs, SF), "t")
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r["doc_id"] for r in good.collect()}
    agree = [(i in left) == bool(q) for i, q in marks.items()]
    assert sum(agree) >= 0.98 * len(agree) and good.columns == docs.columns

    single = staged(stage[1](spark, good, SF), "t")
    groups = brute_components([(r["doc_id"], plain_simhash(r["text"])) for r in good.collect()])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({c for c in groups.values()})

    cut = staged(stage[2](spark, single, SF), "t")
    wanted = brute_cut(sorted((r["doc_id"], r["text"]) for r in single.collect()))
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()} == {
        i: (text, len(text)) for i, text in ((i, w[3].decode(errors="ignore")) for i, w in wanted.items())}

    mixed = staged(stage[3](spark, cut, SF), "t")
    times = {r["doc_id"]: r["times"] for r in mixing.mix(cut).collect()}
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in times.items() if n} and mixed.columns == docs.columns

    tokens = stage[4](spark, mixed, SF).collect()
    vocabulary = bpe.vocabulary(bpe_vocabulary())
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert len(tokens) == mixed.count()
    for r in tokens[::7]:
        assert r["ids"] == list(vocabulary.encode(texts[r["doc_id"]])) and r["decoded"] == vocabulary.decode(r["ids"])


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (odd_docs(spark), odd_docs(spark).limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, SF_DIR), "t")
        assert docs.columns == ["doc_id", "n_tokens", "ids", "decoded"]
        docs.count()
