"""The registered queries of the training-data operators; each reads its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import collocations, exact_dedup, line_dedup, ngram_join, pii, prefix_trie, quality_rules, sentencepiece_codec, source_mix, substring_dedup, token_counts, toxicity, url_filter
from tickloom.session import stage

LIMIT = 1024


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(documents(spark, sf_dir), path).withColumn("over_limit", F.col("n_tokens") > LIMIT)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again: the pieces as count and hash, the text as digest,
    and whether it came back as it was (a null as an empty text)."""
    pieces = sentencepiece_codec.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rows, ids = sentencepiece_codec.encode(documents(spark, sf_dir), pieces, ["doc_id", "text"])
    back, text = sentencepiece_codec.decode(rows, pieces, ["doc_id", "text", ids], ids)
    return back.select(
        "doc_id", F.size(ids).cast("long").alias("n_pieces"), F.xxhash64(ids).alias("pieces_hash"),
        F.sha2(text, 256).alias("decoded_sha256"), (F.col(text) == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.ngram_join(documents(spark, sf_dir), k=3, num=9, den=10)
    return found.select("doc_id", "n_shingles", "component_id")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, name = quality_rules.ledger(documents(spark, sf_dir), ["doc_id"])
    failed = F.col(name)["failed"]
    measures = [F.col(name)[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return rows.select(
        "doc_id", *measures,
        (~quality_rules.passes(failed, "base")).alias("base_failed"),
        quality_rules.passes(failed, "v1").alias("kept"),
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the quality policy does by itself, from the ledger of all documents."""
    rows, name = quality_rules.ledger(documents(spark, sf_dir), ["doc_id"])
    return quality_rules.ablations(rows, F.col(name)["failed"], "v1")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(documents(spark, sf_dir))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the training order holds of every document: words of all its copies, and the position of the first.

    A document that is taken is known by its place on its source's line, as ids may repeat or be null."""
    rows, name = source_mix.mix(documents(spark, sf_dir), ["doc_id", "source"])
    rows = stage(rows.select("doc_id", source_mix.source_key(F.col("source")).alias("source"), f"{name}.*"), "mix")
    order, at = source_mix.in_order(rows.withColumn(name, F.struct(*rows.columns[2:])), name, ["doc_id", "source", "place"])
    met = order.groupBy("source", "place").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first"))
    # Documents that are not taken have no copies to meet; they may share a place with others.
    rest = rows.where("copies = 0").withColumns({"n": F.lit(0).cast("long"), "first": F.lit(None).cast("double")})
    rows = rows.where("copies > 0").join(met, ["source", "place"], "left").unionByName(rest)
    taken = F.col("size") * F.coalesce("n", F.lit(0))
    return rows.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), F.round("first", 6).alias("first_position"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogates(documents(spark, sf_dir), key="tickloom")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each with the first turns of the first of its five."""
    turns = prefix_trie.turns_in_order(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    n_head = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    return prefix_trie.prefix_trie(*prefix_trie.with_heads_of(turns, F.col("conv") - F.col("conv") % 5, n_head, most=8))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list of rules, else by rules mined from the labels of the documents it shows."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labelled = url_filter.labels_of_pages(pages, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return url_filter.judge(pages, url_filter.mined_rules(labelled), ["page_id"])


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of two and three words of every language."""
    return collocations.collocations(documents(spark, sf_dir), min_count=10, max_words=3, top=2000, inside_percent=50)


def queries() -> dict:
    return {name: job for name, job in globals().items() if name.startswith("op")} | {"quality_ablations": quality_ablations}
