"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bazaarspark.llm import block_search, conversation_trie, extendible_shards, run_index_dedup, tile_neighbours, wavelet_fim
from bazaarspark.llm.common import shared_folder, table
from bazaarspark.llm.cube_mixing import mixing_plan
from bazaarspark.llm.ftrl_quality import quality_scores
from bazaarspark.llm.gated_toxicity import toxicity_scores
from bazaarspark.llm.piece_codec import piece_digests
from bazaarspark.llm.registry import Query
from bazaarspark.llm.token_files import token_digests, write_tokens
from bazaarspark.llm.unit_dedup import unit_spans
from bazaarspark.llm.wildcard_simhash import simhash_digest

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def op1(spark: SparkSession, folder: str) -> DataFrame:
    return piece_digests(table(spark, folder, "documents"), PIECES)


def op2(spark: SparkSession, folder: str) -> DataFrame:
    return unit_spans(table(spark, folder, "documents"))


def op3(spark: SparkSession, folder: str) -> DataFrame:
    return tile_neighbours.neighbour_classes(table(spark, folder, "embeddings"))


def op4(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_digest(table(spark, folder, "documents"))


def op5(spark: SparkSession, folder: str) -> DataFrame:
    return extendible_shards.shard_rows(table(spark, folder, "documents"))


def op6(spark: SparkSession, folder: str) -> DataFrame:
    return block_search.top_k(table(spark, folder, "embeddings"))


def op7(spark: SparkSession, folder: str) -> DataFrame:
    files = shared_folder(spark, "token-files")
    write_tokens(table(spark, folder, "documents"), BYTES, files)
    return token_digests(spark, files)


def op8(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9(spark: SparkSession, folder: str) -> DataFrame:
    return mixing_plan(table(spark, folder, "documents"))


def op10(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, folder, "conversations"), share_starts=True)


def op12(spark: SparkSession, folder: str) -> DataFrame:
    return run_index_dedup.repeat_digests(table(spark, folder, "documents"))


def op13(spark: SparkSession, folder: str) -> DataFrame:
    return wavelet_fim.fim_digests(table(spark, folder, "documents"))


QUERIES = {
    "op1_sentencepiece": Query(op1),
    "op2_unit_dedup": Query(op2),
    "op3_embedding_neighbours": Query(op3, tile_neighbours.SQL),
    "op4_simhash": Query(op4),
    "op5_sharding": Query(op5, extendible_shards.SQL),
    "op6_exact_top_k": Query(op6, block_search.SQL),
    "op7_token_files": Query(op7),
    "op8_toxicity": Query(op8),
    "op9_source_mixing": Query(op9),
    "op10_quality": Query(op10),
    "op11_conversation_trie": Query(op11, conversation_trie.SQL),
    "op12_run_index_dedup": Query(op12, run_index_dedup.SQL),
    "op13_fill_in_middle": Query(op13, wavelet_fim.SQL),
}
