"""The corpus pipeline: STAGES in order, each over what its predecessor kept, written as Parquet between them.

Toxic documents go, one document of each group of near-duplicates stays, windows of words that repeat are cut out of texts,
documents that hold a benchmark item go, and what is left is encoded. SQL can't express the stages; tests/llm has each
against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import bpe, decontam, simhash, substring, toxicity
from headway.llm.common import forget, read_table, written
from headway.llm.queries import tokenizer_spec


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.clean(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs, tokenizer_spec()).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        if before is not None:
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
