"""Titles ranked for queries: an inverted index with document frequencies and length-normalised scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut

# Fixed values of the usual formula: saturation of repeats, weight of length.
K1, B = 1.2, 0.75


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order, with repeats."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def postings(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """``doc, word, tf, n``: the words of each document, how often, and the document's length; each repeat is summed within its row."""
    own = docs.select(F.col(id_).alias("doc"), words(F.col(text)).alias("ws"))
    told = own.select("doc", F.size("ws").alias("n"), F.explode("ws").alias("word"))
    return told.groupBy("doc", "word", "n").agg(F.count(F.lit(1)).alias("tf"))


def best_matches(docs: DataFrame, queries: DataFrame, id_: str = "doc", text: str = "text", query: str = "query", query_text: str = "text", most: int = 10) -> DataFrame:
    """``query, doc, score, rank``: the ``most`` documents of highest score above 0 for each query; ties by document.

    A word that df of N documents hold weighs ln(1 + (N - df + .5) / (df + .5)); a document of n words that holds it tf
    times gets tf (k + 1) / (tf + k (1 - b + b n / mean n)) of it; each distinct word of a query counts once. Scores are
    rounded to nine decimals, so that the order of a sum decides no rank. Documents
    without words count in N and the mean. Only lists of words that some query has are kept and joined, each list
    dealt out with its word; each task hands on its best ``most`` of a query.
    """
    asked = queries.select(F.col(query).alias("query"), F.explode(F.array_distinct(words(F.col(query_text)))).alias("word"))
    asked = cut(asked)
    size = docs.agg(F.count(F.lit(1)).alias("docs"), F.avg(F.size(words(F.col(text)))).alias("mean")).first()
    wanted = asked.select("word").distinct()
    lists = cut(postings(docs, id_, text).join(wanted, "word", "left_semi"))
    often = lists.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    weight = F.log(1 + (size.docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    gain = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("n") / (size.mean or 1.0)))
    scored = lists.join(often, "word").select("word", "doc", (weight * gain).alias("s"))
    summed = scored.join(asked, "word").groupBy("query", "doc").agg(F.round(F.sum("s"), 9).alias("score")).where("score > 0")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "doc"))
    return summed.withColumn("rank", rank).where(F.col("rank") <= most)
