"""From `documents` to token ids: quality filter, near-duplicates, repeated passages, source mix, pieces.

Each stage works on all that the stage before it kept and returns the columns of `documents`; the last returns what is
written for training. `text` and `n_chars` change where a stage cuts a text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarspark.llm.common import removed, table, written
from bazaarspark.llm.cube_mixing import mixed
from bazaarspark.llm.ftrl_quality import kept_by_quality
from bazaarspark.llm.piece_codec import with_pieces
from bazaarspark.llm.unit_dedup import without_repeats
from bazaarspark.llm.wildcard_simhash import DISTANCE, SHINGLE, one_of_each

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return kept_by_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, linked as `op4_simhash` links them: four words, four bits."""
    return one_of_each(docs, size=SHINGLE, distance=DISTANCE)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has."""
    return without_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text that the ids decode to."""
    found = with_pieces(docs, PIECES, remembered=100_000)  # what the stages before have left in memory comes on top
    return found.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding and decoding", pieces),
]

# Neither the classifier nor the digests of SimHash can be written in SQL; tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's result is written and read again: a stage that reads its input twice reads the same rows.

    What a stage has read goes once its own result is there.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
        if before is not None:
            removed(before)
        before = docs
    return docs
