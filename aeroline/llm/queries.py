"""One query per operator, over its whole table; each derives its columns from the operator's own output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroline.llm import ann, bpe, codes, langid, licenses, mixing, phrases, quality, repeats, simhash, toxicity, whitening, wrappers


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bpe_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    found = ann.Index(vectors).search(vectors.where("vec_id % 100 = 0"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(_table(spark, sf_dir, "documents"), bpe_vocabulary(), readable=True)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
        F.sha2("text", 256).alias("text_sha256"))


def op5_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(_table(spark, sf_dir, "pages"))


def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.predict(docs, model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op9_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.without_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_binary_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = codes.sign_codes(_table(spark, sf_dir, "embeddings"))
    found = codes.search(rows, rows.where("id % 50 = 0"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kmeans_tree": op1_kmeans_tree,
    "op2_licenses": op2_licenses,
    "op3_simhash": op3_simhash,
    "op4_bpe": op4_bpe,
    "op5_wrappers": op5_wrappers,
    "op6_cotraining": op6_cotraining,
    "op7_mixing": op7_mixing,
    "op8_language": op8_language,
    "op9_suffix_arrays": op9_suffix_arrays,
    "op10_binary_topk": op10_binary_topk,
    "op11_phrases": op11_phrases,
    "op12_toxicity": op12_toxicity,
    "op13_whitening": op13_whitening,
}
