"""Documents to training data: quality filter, near-duplicate filter, repeated passages, mixing, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroline.llm import bpe, mixing, quality, repeats, simhash
from aeroline.llm.queries import bpe_vocabulary
from aeroline.session import staged


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return quality.good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return simhash.without_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without bytes that an earlier document has too; characters cut apart go as well. A text that is left empty stays."""
    return repeats.cut_texts(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes, none for some."""
    return mixing.repeated(docs).select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` of every row."""
    return bpe.encode(docs, bpe_vocabulary()).select(
        "doc_id", "n_tokens", F.transform(F.filter(F.split("ids", " "), lambda x: x != ""), lambda x: x.cast("int")).alias("ids"), "decoded")


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", tokenize),
]

# The classifier's numeric fit, the suffix arrays and the tokenizer have no SQL form; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
