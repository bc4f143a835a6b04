"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources get targets in words from their weights, none above twice its size. Each
source is cut into shards of bounded size and each shard, its documents in a
seeded order, into blocks of equal token count. Seats (blocks) go to sources by
highest quotients ``target / (2 k + 1)``, then a source's seats go to its shards in
the same way. A shard with ``q`` seats and ``b`` blocks takes every block ``q div b``
times and a seeded run of ``q mod b`` blocks once more. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, read_table

BLOCK_TOKENS = 64
SHARD_TOKENS = 1 << 18
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
SEED = 20260711


def token_count(text: Column) -> Column:
    """Number of runs of characters other than space and 0x09-0x0D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``source, source_size, weight, target`` from rows ``source, size``.

    Sources in code-point order, null last, take the weights in turn. Capped sources
    are those of the smallest size per weight: with sources ordered by
    ``size / weight`` the capped ones form a prefix, and the level that the others
    share follows from running sums, with no iteration.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    rank = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighted = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank + 1).cast("int")))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    whole = Window.partitionBy()
    up_to = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = weighted.select(
        "*",
        F.sum("source_size").over(whole).alias("_all"),
        F.coalesce(F.sum("source_size").over(up_to), F.lit(0)).alias("_size_before"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(up_to), F.lit(0.0))).alias("_weight_left"),
    )
    per_weight = (F.lit(share) * F.col("_all") - F.lit(cap) * F.col("_size_before")) / F.col("_weight_left")
    level = level.withColumn("_fits", per_weight * F.col("weight") <= F.lit(cap) * F.col("source_size"))
    level = level.withColumn("_at", F.row_number().over(by_ratio))
    first_free = F.min(F.when(F.col("_fits"), F.struct(F.col("_at"), per_weight.alias("level")))).over(whole)
    level = level.withColumn("_first", first_free)
    level = level.withColumn("_free", F.coalesce(F.col("_at") >= F.col("_first")["_at"], F.lit(False)))
    level = level.withColumn("_level", F.col("_first")["level"])
    target = F.when(F.col("_free"), F.col("_level") * F.col("weight")).otherwise(F.lit(cap) * F.col("source_size"))
    return level.select("source", "source_size", "weight", target.cast("double").alias("target"))


def sainte_lague(parties: DataFrame, group: list[str], key: list[str]) -> DataFrame:
    """Seats for each party by highest quotients ``votes / (2 k + 1)``.

    ``parties`` has ``group`` (one election each; may be empty), ``key``, ``votes``,
    ``most`` (a cap on a party's seats) and ``house`` (seats of the election). With
    divisor ``votes / house`` every party starts from its rounded quota; the seats
    still missing or in excess, fewer than the parties, are settled by ranking the
    next quotients. A party with share p can gain or lose p * (missing + parties) + 1
    of them, so about three quotients a party are ranked, whatever the house.
    """
    g = Window.partitionBy(*group)
    votes = F.sum("votes").over(g)
    p = parties.select("*", votes.alias("_votes"), F.count(F.lit(1)).over(g).alias("_n"))
    quota = F.when(F.col("_votes") > 0, F.col("votes") * F.col("house") / F.col("_votes")).otherwise(F.lit(0.0))
    p = p.withColumn("_start", F.least(F.floor(quota + 0.5), F.col("most")).cast("long"))
    p = p.withColumn("_open", (F.col("house") - F.sum("_start").over(g)).cast("long"))
    near = (F.floor(F.when(F.col("_votes") > 0, F.col("votes") / F.col("_votes")).otherwise(F.lit(0.0)) * (F.abs("_open") + F.col("_n"))) + 2).cast("long")
    first = F.when(F.col("_open") > 0, F.col("_start") + 1).otherwise(F.greatest(F.lit(1), F.col("_start") - near))
    last = F.when(F.col("_open") > 0, F.least(F.col("_start") + near, F.col("most"))).otherwise(F.col("_start"))
    moving = p.where("_open != 0").select(*group, *key, "votes", "_open", first.alias("_first"), last.alias("_last"))
    seats = moving.where("_last >= _first").withColumn("_k", F.explode(F.sequence("_first", "_last")))
    seats = seats.withColumn("_q", F.col("votes") / (2 * F.col("_k") - 1))
    ties = [F.xxhash64(*key, F.lit(SEED)), *key]
    best = Window.partitionBy(*group).orderBy(F.col("_q").desc(), *ties)
    worst = Window.partitionBy(*group).orderBy(F.col("_q").asc(), *[F.desc(F.col(k)) if isinstance(k, str) else k.desc() for k in ties])
    rank = F.when(F.col("_open") > 0, F.row_number().over(best)).otherwise(F.row_number().over(worst))
    seats = seats.withColumn("_rank", rank).where(F.col("_rank") <= F.abs("_open"))
    moved = seats.groupBy(*group, *key).agg(F.sum(F.signum("_open")).cast("long").alias("_moved"))
    on = [F.col(f"p.{c}").eqNullSafe(F.col(f"m.{c}")) for c in [*group, *key]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    kept = [F.col(f"p.{c}") for c in parties.columns]
    return p.alias("p").join(moved.alias("m"), cond, "left").select(*kept, (F.col("_start") + F.coalesce("_moved", F.lit(0))).alias("seats"))


def _mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    block: int = BLOCK_TOKENS,
    shard: int = SHARD_TOKENS,
    seed: int = SEED,
) -> DataFrame:
    """``mix`` with ``text_key``, a hash of the row's text."""
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), token_count(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("text_key"))
    sizes = materialize(sized, "sizes")
    targets = materialize(source_targets(sizes, weights, share, cap), "targets")

    # Shards: as many as a source's size asks for, dealt by a seeded hash.
    n_shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(shard))).cast("long")
    spread = F.xxhash64(F.col("doc_id"), F.lit(seed))
    one = sizes.join(
        F.broadcast(targets.select(F.col("source").alias("_s"), "source_size", "target")) if _few(targets) else targets.select(F.col("source").alias("_s"), "source_size", "target"),
        F.col("source").eqNullSafe(F.col("_s")),
    )
    placed = one.select("doc_id", "text_key", "source", "size", "source_size", "target", F.pmod(spread, n_shards).alias("shard"))
    shards = placed.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    shards = shards.where("shard_size > 0").withColumn("blocks", F.ceil(F.col("shard_size") / F.lit(block)).cast("long"))
    shards = materialize(shards, "shards")

    # House of all sources, in blocks; a source may fill twice its blocks, a shard likewise.
    own = shards.groupBy("source").agg(F.sum("blocks").alias("blocks"), F.sum("shard_size").alias("words"))
    parties = own.join(targets.select(F.col("source").alias("_s"), "target"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # A source's blocks hold words / blocks tokens on average, the last of each shard being short.
    parties = parties.withColumn("votes", F.col("target") * F.col("blocks") / F.col("words"))
    house = F.round(F.sum("votes").over(Window.partitionBy())).cast("long")
    parties = parties.select("source", "votes", F.floor(F.col("blocks") * F.lit(float(cap)) + 1e-9).cast("long").alias("most"), house.alias("house"))
    by_source = sainte_lague(parties, [], ["source"])
    house_of = by_source.select(F.col("source").alias("_s"), F.col("seats").alias("house"))
    in_source = shards.join(house_of, F.col("source").eqNullSafe(F.col("_s")))
    in_source = in_source.select("source", "shard", "shard_size", "blocks", F.col("blocks").cast("double").alias("votes"), F.floor(F.col("blocks") * F.lit(float(cap)) + 1e-9).cast("long").alias("most"), "house")
    quotas = sainte_lague(in_source, ["source"], ["shard"])
    start = F.pmod(F.xxhash64("source", "shard", F.lit(seed + 1)), F.col("blocks"))
    quotas = quotas.select(
        F.col("source").alias("_s"),
        F.col("shard").alias("_h"),
        "shard_size",
        F.expr("seats div blocks").alias("passes"),
        (start * block).alias("from_a"),
        F.expr("seats % blocks").alias("_run"),
        start.alias("_start"),
        F.col("blocks").alias("_blocks"),
    )
    quotas = quotas.withColumn("to_a", F.least((F.col("_start") + F.col("_run")) * block, F.col("shard_size")))
    quotas = quotas.withColumn("to_b", F.greatest(F.lit(0), F.col("_start") + F.col("_run") - F.col("_blocks")) * block)
    quotas = materialize(quotas.drop("_run", "_start", "_blocks"), "quotas")

    at = Window.partitionBy("source", "shard").orderBy(F.xxhash64("doc_id", F.lit(seed + 2)), "doc_id", "size", "text_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lined = placed.withColumn("_end", F.sum("size").over(at)).withColumn("_begin", F.col("_end") - F.col("size"))
    q = F.broadcast(quotas) if _few(quotas) else quotas
    joined = lined.join(q, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_h")), "left")

    def overlap(low: Column, high: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("_end"), high) - F.greatest(F.col("_begin"), low))

    taken = F.col("passes") * F.col("size") + overlap(F.col("from_a"), F.col("to_a")) + overlap(F.lit(0), F.col("to_b"))
    return joined.select(
        "doc_id",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        F.col("target").cast("double").alias("target"),
        F.coalesce(taken, F.lit(0)).cast("long").alias("taken"),
        "text_key",
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each row of ``docs``.

    ``taken`` counts the words that the chosen blocks take from the row, repeats
    counted: 2 * size at most. Null texts and texts without words have size 0 and
    take 0. A null source is a source of its own. The order within a shard depends on
    the seed, the id, the text's size and its hash alone; rows equal in these are alike, so
    reruns agree. Options: ``weights, share, cap, block, shard, seed``; ``cap`` may be any number. No rows give no rows.
    """
    return _mix(docs, id_col, text_col, source_col, **options).drop("text_key")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` in the mix, each as often as ``taken / size`` rounded half up.

    A row without words is never taken. Rows are told apart by id and text; those equal in both share the largest count.
    """
    taken = _mix(docs, id_col, text_col, source_col, **options)
    times = F.expr("(2 * taken + size) div (2 * size)")
    copies = taken.where("size > 0").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), times.alias("_times")).where("_times > 0")
    copies = copies.groupBy("_id", "_key").agg(F.max("_times").alias("_times"))
    row = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_doc"), F.xxhash64(text_col).alias("_text"))
    met = row.join(copies, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key")))
    return met.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).select("_row.*")


#: Rows of (source, numbers) that are broadcast at most; beyond it Spark joins by shuffle.
BROADCAST_ROWS = 10_000


def _few(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))
