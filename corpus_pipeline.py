"""A corpus pipeline of five stages, each written as Parquet and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from safra.llm import byte_bpe, exact_dedup, jaccard_join, language_id, mixing
from safra.llm.common import crc_mod, materialize, read_table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in no language go. The model learns from the labelled two thirds of what came in."""
    return language_id.identified(docs, docs.where(crc_mod(F.col("doc_id"), 3) != 1))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the largest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts whose five-word shingles are 0.8 alike, the smallest doc_id stays."""
    return jaccard_join.one_of_each(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: the words taken over its words, rounded half up: 0, 1 or 2 times."""
    return mixing.mixed(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of their decoding."""
    return byte_bpe.encoded(docs, byte_bpe.load_codec())


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", near_stage),
    ("source_mix", mix_stage),
    ("byte_bpe", encode_stage),
]

#: Language, near-duplicate and mixing decisions have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
