"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatlens.llm import bpe, hamming, neighbours, revisits, rules, tries
from seatlens.llm.alignment import align
from seatlens.llm.jaccard import jaccard_groups
from seatlens.llm.language import identify
from seatlens.llm.packing import pack
from seatlens.llm.pii import pii_digests
from seatlens.llm.secrets import secret_digests
from seatlens.llm.sharding import shard_digests

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(documents(spark, sf_dir), shingle=3, percent=90)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digests(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(documents(spark, sf_dir), labels(spark, sf_dir)).drop("row")


def op4_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = neighbours.held_out("doc_id", 4, 2)
    scored = neighbours.classify(documents(spark, sf_dir), labels(spark, sf_dir), learn=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(documents(spark, sf_dir))


def op6_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    codes = vectors.select(F.col("vec_id").alias("id"), hamming.sign_code(F.col("embedding")).alias("code"))
    return hamming.nearest_codes(codes, codes.where(F.col("id") % 100 == 0), k=10)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = revisits.resolve_revisits(revisits.page_captures(pages))
    lines = F.transform("headers", lambda h: F.concat(h["key"], F.lit(": "), h["value"]))
    return found.withColumn("headers", F.array_join(lines, "\n"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    return bpe.decode(encoded, path).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = neighbours.held_out("doc_id", 3, 1)
    found = identify(documents(spark, sf_dir), learn=~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path_a, path_b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align(documents(spark, sf_dir), path_a, path_b).documents.drop("groups")


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digests(documents(spark, sf_dir), shards=40)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return tries.prefix_trie(tries.branched(tries.conversation_paths(turns)))


def queries() -> dict[str, Query]:
    return {
        "op1_jaccard_join": op1_jaccard_join,
        "op2_pii": op2_pii,
        "op3_quality_rules": op3_quality_rules,
        "op4_quality_neighbours": op4_quality_neighbours,
        "op5_secrets": op5_secrets,
        "op6_hamming_top_k": op6_hamming_top_k,
        "op7_packing": op7_packing,
        "op8_revisits": op8_revisits,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_language": op10_language,
        "op11_tokenizer_alignment": op11_tokenizer_alignment,
        "op12_sharding": op12_sharding,
        "op13_prefix_trie": op13_prefix_trie,
    }
