"""Exact deduplication by skew-safe combining.

Three combining stages, each comparing whole texts, never digests alone:

1. every map task deduplicates its own rows (the partial side of a grouping on
   the whole text);
2. salted digest groups are merged: a text's survivors meet in one of
   ``salts`` groups, so thousands of copies never meet in one task;
3. the salt winners of a text, ``salts`` at most, are combined.

Groups of two rows or more are then joined back to the documents by digest. Stage 3
has by then told equal digests of different texts apart; should there be any, the
join compares the texts as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, read_table

SALTS = 8


def _norm(text_col: str) -> Column:
    return ascii_lower(F.coalesce(F.col(text_col), F.lit("")))


def _with_groups(docs: DataFrame, carried: list[str], id_col: str, text_col: str, salts: int) -> DataFrame:
    """``docs.row`` (struct of the carried columns), ``digest, keep_id, n`` (null for single texts)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), _norm(text_col).alias("norm"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", F.spark_partition_id()), F.lit(salts)))
    merged = salted.groupBy("digest", "salt", "norm").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n"))
    whole = merged.groupBy("digest", "norm").agg(F.max("top").alias("keep_id"), F.sum("n").alias("n"))
    groups = materialize(whole.select("digest", "keep_id", "n"), "digests")
    collided = bool(groups.groupBy("digest").count().where("count > 1").limit(1).count())

    own = docs.select(F.struct(*carried).alias("row"), _norm(text_col).alias("norm"))
    own = own.withColumn("digest", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)))
    if collided:
        return own.join(whole.where("n > 1"), ["digest", "norm"], "left")
    return own.drop("norm").join(groups.where("n > 1"), "digest", "left")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    The row with the largest id stays. Rows that repeat both id and text stand for
    one document: they count in ``group_size`` and share ``kept``. Null ids rank
    lowest; a group of null ids only has a null ``keep_id`` and all its rows are
    kept. An empty table gives an empty result; other columns are ignored.
    """
    found = _with_groups(docs, [id_col], id_col, text_col, salts)
    doc_id = F.col("row")[id_col].cast("long")
    keep_id = F.when(F.col("n").isNull(), doc_id).otherwise(F.col("keep_id"))
    return found.select(
        doc_id.alias("doc_id"),
        keep_id.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        doc_id.eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns unchanged."""
    found = _with_groups(docs, docs.columns, id_col, text_col, salts)
    stays = F.col("n").isNull() | F.col("row")[id_col].cast("long").eqNullSafe(F.col("keep_id"))
    return found.where(stays).select("row.*")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), g AS (
  SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""
