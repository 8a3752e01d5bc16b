"""The corpus pipeline: from `documents` to encoded training rows in training order."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import exact_dedup, ngram_join, quality_rules, sentencepiece_codec, source_mix
from tickloom.session import stage

#: Merges and placements beyond SQL; tests compare every stage with a plain version.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fail no rule of the policy."""
    rows, name = quality_rules.ledger(docs, docs.columns)
    return rows.where(quality_rules.passes(F.col(name)["failed"], "v1")).drop(name)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 of its five-word shingles."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once per copy, sorted by training position."""
    rows, position = source_mix.training_order(docs)
    return rows.drop(position)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids in place of the text."""
    pieces = sentencepiece_codec.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    carry = [x for x in docs.columns if x != "text"]
    rows, ids = sentencepiece_codec.encode(docs, pieces, carry)
    return rows.withColumn("n_pieces", F.size(ids).cast("long"))


STAGES = [
    ("quality_rules", keep_quality),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mix", mix_sources),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
