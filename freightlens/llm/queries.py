"""The queries over the given tables, each applying one operator with its parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm import backoff_lm, byte_bpe, exact_dedup, hard_negatives, html_main
from freightlens.llm import licences, merkle, mixing, multi_index, nbsvm, simhash, suffix_dedup
from freightlens.llm import token_store

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
END_ID = 2


#: Shares of tokens wanted; values not named share the rest as they are.
TARGETS = {
    "source": {"src0": 0.30},
    "lang": {"en": 0.62, "de": 0.14, "fr": 0.14, "es": 0.10},
    "topic": {"prose": 0.80},
}


def marginals() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic(F.col("text"))}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mix of as many tokens as the table has."""
    found = mixing.mix(documents(spark, sf_dir), TARGETS, marginals())
    return found.withColumns(
        {"weight": F.round("weight", 8), "probability": F.round("probability", 6)}
    )


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored(documents(spark, sf_dir), TOKENIZER, END_ID, with_ids=False)


def quality_model(spark: SparkSession, sf_dir: str) -> nbsvm.Model:
    """The model fitted to the labelled rows of the given documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return nbsvm.train(documents(spark, sf_dir), labels)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.score(documents(spark, sf_dir), quality_model(spark, sf_dir))


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(documents(spark, sf_dir))
    return found.withColumns(
        {c: F.array_join(c, ",") for c in ("sentence_ids", "licences")}
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_bpe.encode_and_decode(documents(spark, sf_dir), RANKS, PATTERN)
    return with_digests(found)


def with_digests(encoded: DataFrame, *more: str) -> DataFrame:
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), words=4, max_bits=4)


def op9_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = backoff_lm.score(documents(spark, sf_dir))
    return found.withColumns({c: F.round(c, 4) for c in ("log_score", "mean_log_score")})


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir), keep="largest")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each fiftieth vector, with a seventh of the labels moved on by one."""
    moved = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hard_negatives.mine(vectors, anchor=F.expr("vec_id % 50 = 0"), label=moved)


def op12_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by a model learnt from some of them."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html_main.extract(pages, html_main.train(pages))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, and what becomes of its proofs where a seventh of the rows is tampered with."""
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    n_chars = F.when(struck, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(documents(spark, sf_dir), tampered={"n_chars": n_chars})
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_source_mixing,
        op2_embedding_near_dedup,
        op3_token_store,
        op4_quality_classifier,
        op5_licence_scan,
        op6_byte_bpe,
        op7_suffix_dedup,
        op8_simhash,
        op9_backoff_lm,
        op10_exact_dedup,
        op11_hard_negatives,
        op12_html_main_text,
        op13_merkle_manifest,
    )
}
