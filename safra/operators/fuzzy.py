"""Names nearly alike: an edit-distance join by deletion neighbourhoods, and the merging of series by it.

Two names within k insertions, deletions and substitutions become equal when k letters or fewer are
taken from each, so each name is indexed by what is left of it after up to k deletions, and only
names that share such a rest are compared. Long names have many rests; those of more than ``WHOLE``
letters are split in pieces, of which one at least is left as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as x
from .graph import cut

MERGE = 90.0
WHOLE = 16


def rests(name: Column, most: int) -> Column:
    """What is left of a text after 0 to ``most`` deletions, each once."""
    every = F.array(name)
    for _ in range(most):
        shorter = F.flatten(F.transform(every, lambda t: F.when(F.length(t) > 0, F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))).otherwise(F.array().cast("array<string>"))))
        every = F.array_distinct(F.concat(every, shorter))
    return every


def edit_pairs(names: DataFrame, column: str, most: int = 1) -> DataFrame:
    """``a, b, edits``: distinct names, a before b, at most ``most`` insertions, deletions and substitutions apart."""
    own = names.select(F.col(column).alias("name")).where("name is not null").distinct()
    index = cut(own.select("name", F.explode(rests(F.col("name"), most)).alias("rest")))
    l, r = index.alias("l"), index.alias("r")
    met = l.join(r, (F.col("l.rest") == F.col("r.rest")) & (F.col("l.name") < F.col("r.name"))).select(F.col("l.name").alias("a"), F.col("r.name").alias("b")).distinct()
    return met.withColumn("edits", F.levenshtein("a", "b")).where(F.col("edits") <= most)


def _deletions(least: float) -> Column:
    """Letters that a name of l letters may lose at most: where s is the share that may go, the shortest name alike has l (1 - s) / (1 + s)."""
    share = 1 - least / 100
    return F.floor(F.length("name") * F.lit(2 * share / (1 + share)) + 1e-9).cast("int")


def likely_pairs(names: DataFrame, column: str, least: float = MERGE) -> DataFrame:
    """``a, b, score``: distinct names, a before b, whose likeness (twice the longest common subsequence over both lengths, in percent) is ``least`` or more.

    Names of up to ``WHOLE`` letters meet by their rests after the deletions that this likeness allows them. For longer
    ones the common subsequence leaves out g letters in all; cut in g + 1 pieces, one piece of a is in b as it is, near
    its own place, so these meet by pieces and place.
    """
    own = cut(names.select(F.col(column).alias("name")).where("name is not null and name != ''").distinct().withColumn("gone", _deletions(least)))
    deepest = own.where(F.length("name") <= WHOLE).agg(F.max("gone")).first()[0] or 0
    short = own.where(F.length("name") <= WHOLE)
    index = short.where("gone = 0").select("name", F.col("name").alias("rest"))
    for k in range(1, deepest + 1):
        index = index.unionByName(short.where(F.col("gone") == k).select("name", F.explode(rests(F.col("name"), k)).alias("rest")))
    index = cut(index)
    met = index.join(index.withColumnRenamed("name", "other"), "rest").where("name < other").select(F.col("name").alias("a"), F.col("other").alias("b")).distinct()
    # Pieces: their number depends on both lengths, which either side can name.
    share = 1 - least / 100
    longest = F.floor(F.length("name") * F.lit((1 + share) / (1 - share)) + 1e-9).cast("int")
    span = own.where(F.length("name") > WHOLE / ((1 + share) / (1 - share)))
    sized = span.select("name", F.length("name").alias("n"), F.explode(F.sequence(F.length("name"), longest)).alias("longer"))
    out = F.floor((F.col("n") + F.col("longer")) * F.lit(share) + 1e-9).cast("int")
    left = sized.where(F.col("longer") > WHOLE).withColumn("g", out).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("g"))))
    left = left.withColumns({"from": F.expr("(n * i) div (g + 1)"), "to": F.expr("(n * (i + 1)) div (g + 1)")})
    left = left.where(F.col("to") > F.col("from")).select("name", F.col("n").alias("short"), F.col("longer"), "i", F.expr("substring(name, from + 1, to - from)").alias("piece"))
    right = span.where(F.length("name") > WHOLE).select("name", F.length("name").alias("longer"), F.explode(F.sequence(F.ceil(F.length("name") * F.lit((1 - share) / (1 + share)) - 1e-9).cast("int"), F.length("name"))).alias("short"))
    right = right.withColumn("g", F.floor((F.col("short") + F.col("longer")) * F.lit(share) + 1e-9).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("g"))))
    right = right.withColumns({"from": F.expr("(short * i) div (g + 1)"), "to": F.expr("(short * (i + 1)) div (g + 1)")}).where(F.col("to") > F.col("from"))
    right = right.withColumn("shift", F.explode(F.sequence(-F.col("g"), F.col("g")))).where((F.col("from") + F.col("shift") >= 0) & (F.col("to") + F.col("shift") <= F.col("longer")))
    right = right.select(F.col("name").alias("other"), "short", "longer", "i", F.expr("substring(name, from + shift + 1, to - from)").alias("piece"))
    long = left.join(right, ["short", "longer", "i", "piece"]).where("name != other").select(F.least("name", "other").alias("a"), F.greatest("name", "other").alias("b")).distinct()
    return met.unionByName(long).distinct().withColumn("score", x.likeness("a", "b")).where(F.col("score") >= least)


def fuzzy_merge(names: DataFrame, column: str, least: float = MERGE) -> DataFrame:
    """``name, merged, score``: in order of names, each one that no earlier one has taken takes the later name most like it, if that is ``least`` or more alike.

    Ties go to the first name. Whether a name is taken depends on the names before it: those whose takers are all decided
    are decided round by round, so the rounds are as many as the longest chain of takers, not as the names.
    """
    own = names.select(F.col(column).alias("name")).where("name is not null and name != ''").distinct()
    best = Window.partitionBy("a").orderBy(F.desc("score"), "b")
    choice = cut(likely_pairs(names, column, least).withColumn("_r", F.row_number().over(best)).where("_r = 1").select(F.col("a").alias("name"), F.col("b").alias("merged"), "score"))
    state = cut(own.withColumn("taken", F.lit(None).cast("boolean")))
    while True:
        takers = choice.join(state, "name").groupBy(F.col("merged").alias("_m")).agg(F.bool_or(F.coalesce(~F.col("taken"), F.lit(False))).alias("_by"), F.bool_or(F.col("taken").isNull()).alias("_open"))
        known = F.when(F.col("_m").isNull(), False).when(F.col("_by"), True).when(~F.col("_open"), False)
        state = cut(state.join(takers, state["name"] == takers["_m"], "left").select("name", F.coalesce("taken", known).alias("taken")))
        if not state.where("taken is null").limit(1).count():
            break
    return state.where("not taken").join(choice, "name").select("name", "merged", "score")
