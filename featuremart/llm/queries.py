"""Registered queries of the operators and of the pipeline, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.llm import (
    align, chat, lattice, lines, mixing, packing, periodic, pieces, quality, rollups, simhash, topk, toxicity,
)
from featuremart.operators.scratch import scratch_path

QUERIES = {}
ORACLES = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The tokenizer of the contract; installed on every executor."""
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    """The SentencePiece model of the contract; installed on every executor."""
    return public_tokenizers.path("piece_bpe_32k.model")


def query(oracle: str | None = None):
    def add(build):
        QUERIES[build.__name__] = build
        if oracle:
            ORACLES[build.__name__] = oracle
        return build

    return add


@query()
def op6_simhash_pivots(spark, sf_dir):
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query(oracle=lines.ORACLE)
def op4_line_templates(spark, sf_dir):
    """Every document without the lines of templates that recur across documents."""
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select(
        "row.doc_id", F.col("kept_text").alias("text"), "n_lines", "n_dropped"
    )


@query()
def op8_cube_mixing(spark, sf_dir):
    """Words the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query()
def op2_bin_completion(spark, sf_dir):
    """Place of every piece of every document in the packed sequences."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query()
def op9_classifier_chain(spark, sf_dir):
    """Chance of each toxicity category of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(oracle=topk.ORACLE)
def op10_block_max_topk(spark, sf_dir):
    """Ten best of every row whose id is divisible by 100, against all rows."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query(oracle=chat.ORACLE)
def op5_chat_round_trip(spark, sf_dir):
    """Digests of every conversation, read back from the formatted text."""
    return chat.digests(chat.with_conflict(table(spark, sf_dir, "conversations")))


@query()
def op7_token_rollups(spark, sf_dir):
    """Documents and tokens by source, language and tokenizer, after three batches of changes."""
    return rollups.corpus_counts(
        table(spark, sf_dir, "documents"), scratch_path(spark, "rollup"), tokenizer_path(),
        "byte_bpe_50k/1",
    )


@query()
def op3_weak_label_quality(spark, sf_dir):
    """Chance that each document is good."""
    return quality.scores(table(spark, sf_dir, "documents"))


@query(oracle=lattice.ORACLE)
def op1_e8_lattice(spark, sf_dir):
    """Links and component of every vector."""
    return lattice.vector_components(table(spark, sf_dir, "embeddings"))


@query()
def op13_sentencepiece_backtracking(spark, sf_dir):
    """Digests of the ids of every document and of the text they decode to."""
    return pieces.digests(table(spark, sf_dir, "documents"), piece_model_path())


@query()
def op12_difference_cover_runs(spark, sf_dir):
    """Runs of repeated words of every document, with periods planted in one in ten."""
    return periodic.digests(periodic.with_planted_periods(table(spark, sf_dir, "documents")))


@query()
def op11_merge_asof_alignment(spark, sf_dir):
    """Groups and links of the tokens of two tokenizers in every document."""
    return align.digests(table(spark, sf_dir, "documents"), tokenizer_path(), piece_model_path())
