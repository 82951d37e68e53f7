"""The corpus pipeline: from raw documents to a sampled, tokenised training set.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. The result of each is written to the shared
folder and read again, so a lost executor costs one stage's tasks at most.

Nulls, empty texts and repeated rows are handled as each operator states. The
near-duplicate stage names rows by doc_id and text, so either may repeat.
An empty table gives no rows; other columns are passed on up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freightlens.llm import byte_bpe, exact_dedup, mixing, nbsvm, queries, simhash
from freightlens.llm.common import saved

#: Not to be expressed in SQL: a trained model, hashes of shingles, and merges.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return nbsvm.keep_good(docs, queries.quality_model(spark, sf_dir))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each text: the one with the largest doc_id."""
    return exact_dedup.without_duplicates(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return simhash.without_near_duplicates(docs, words=4, max_bits=4)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix with the target weights: each document as often as it has copies."""
    return mixing.sample(docs, queries.TARGETS, queries.marginals())


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and the digests of its ids and of the text they decode to."""
    found = byte_bpe.encode_and_decode(docs, queries.RANKS, queries.PATTERN)
    return queries.with_digests(found, "ids")


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("mixing sources", mixed),
    ("byte-level bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the given documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
