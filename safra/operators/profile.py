"""Profiles of tables and fields, variables across tables, and how alike they are."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import text as x
from .graph import connected_components

SAMPLE_ROWS = 500
DISTINCT_HEAD = 1000
TOP_VALUES = 12
#: Sets of so many values at most travel with their index entries, so that pairs of them are judged where they meet.
SHORT_SET = 32
#: Cells, and bytes of them, that a task holds at most while it reduces its own, but for one batch more.
HELD = 131_072
HELD_BYTES = 1 << 24


def long_form(rows: DataFrame, source: str, sample_rows: int | None = SAMPLE_ROWS, order: str | None = None) -> DataFrame:
    """``path, name, position, value`` (trimmed text): the cells of a table, or of its first rows.

    ``position`` orders the rows: the column ``order``, a number without repeats, or else the order of reading. No row is
    numbered anew, so a whole table (``sample_rows=None``) stays where it is.
    """
    head = rows.orderBy(order).limit(sample_rows) if order and sample_rows else rows.limit(sample_rows) if sample_rows else rows
    placed = head.select((F.col(order).cast("long") if order else F.monotonically_increasing_id()).alias("_position"), *[F.trim(F.col(c).cast("string")).alias(c) for c in rows.columns])
    return placed.unpivot(["_position"], rows.columns, "name", "value").select(F.lit(source).alias("path"), "name", F.col("_position").alias("position"), F.nullif("value", F.lit("")).alias("value"))


def primitive_type(name: Column, s: dict[str, Column]) -> Column:
    """By name and by facts about the non-empty values: ``n, digits, len100, distinct50, dates50, floats50, distinct100``."""
    upper = F.upper(name)
    codes_ = F.when((s["len100"] <= 2) & (s["distinct50"] <= 20), "categorical_code").otherwise("integer")
    whole = F.when((s["len100"] == 2) & (s["short100"] == 2) & upper.startswith("DT"), "date_fragment").otherwise(codes_)
    return (
        F.when(s["n"] == 0, "empty").when(upper.startswith("CODMUN"), "municipality_code").when(s["digits"], whole).when(s["dates50"], "date")
        .when(s["floats50"], "numeric").when(s["distinct100"] <= 20, "categorical_text").otherwise("text")
    )


def _first_cells(batches: Iterator[pa.RecordBatch], most: int, held: int = HELD) -> Iterator[pa.RecordBatch]:
    """Of a task's ``path, name, position, value``, at least the first ``most`` of each field by position (nulls first).

    A cell that comes after ``most`` held ones of its field is dropped at once. Where fields are so many that their first
    cells alone are over the limit, they are handed on and the task begins anew.
    """
    fields: dict[tuple, int] = {}
    last: list = []  # by field, the position of the last of its first cells, once there are so many
    kept: list[pa.Table] = []
    rows = size = full = 0

    def first() -> pa.Table:
        table = pa.concat_tables(kept).combine_chunks()
        table = table.take(pc.sort_indices(table.select(["field", "position"]), sort_keys=[("field", "ascending"), ("position", "ascending")], null_placement="at_start"))
        field = table["field"].to_numpy()
        begin = np.flatnonzero(np.diff(field, prepend=-1))
        nth = np.arange(len(field)) - np.repeat(begin, np.diff(begin, append=len(field)))
        for i in np.flatnonzero(nth == most - 1):
            last[field[i]] = table["position"][int(i)].as_py()
        return table.filter(pa.array(nth < most))

    for batch in batches:
        if not len(batch):
            continue
        path, name = (batch[k].dictionary_encode(null_encoding="encode") for k in ("path", "name"))
        pairs, of = np.unique(path.indices.to_numpy().astype(np.int64) * len(name.dictionary) + name.indices.to_numpy(), return_inverse=True)
        told = []
        for p, n in zip(*divmod(pairs, len(name.dictionary)), strict=True):
            told.append(fields.setdefault((path.dictionary[int(p)].as_py(), name.dictionary[int(n)].as_py()), len(fields)))
        last += [None] * (len(fields) - len(last))
        field = np.array(told, np.int64)[of]
        bound = pa.array([last[f] for f in told], batch["position"].type).take(pa.array(of))
        table = pa.table({**{k: batch[k] for k in batch.schema.names}, "field": field}).filter(pc.fill_null(pc.less(batch["position"], bound), True))
        if len(table):
            kept.append(table)
            rows, size = rows + len(table), size + table.nbytes
        if rows > full + held or size > HELD_BYTES:
            kept = [first()]
            rows = full = len(kept[0])
            size = kept[0].nbytes
            if rows > held or size > HELD_BYTES // 2:
                yield from kept[0].drop_columns("field").to_batches()
                fields, last, kept, rows, size, full = {}, [], [], 0, 0, 0
    if kept:
        yield from first().drop_columns("field").to_batches()


def _counted_cells(batches: Iterator[pa.RecordBatch], held: int = HELD) -> Iterator[pa.RecordBatch]:
    """``path, name, value, n, at``: a task's equal cells counted, with their least position, so many cells at a time."""

    def counted(cells: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        told = pa.Table.from_batches(cells).group_by(["path", "name", "value"], use_threads=False).aggregate([([], "count_all"), ("position", "min")])
        return told.select(["path", "name", "value", "count_all", "position_min"]).rename_columns(["path", "name", "value", "n", "at"]).to_batches()

    some: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        some.append(batch)
        rows, size = rows + len(batch), size + batch.nbytes
        if rows >= held or size > HELD_BYTES:
            yield from counted(some)
            some, rows, size = [], 0, 0
    if rows:
        yield from counted(some)


def field_profiles(cells: DataFrame) -> DataFrame:
    """One row per (path, name): counts, distinct among the first thousand values, the twelve most frequent
    values (ties by first appearance), an inferred type and signals."""
    keys = ["path", "name"]
    v = F.col("value")
    plain = F.regexp_replace(v, "[-/]", "")
    counts = cells.groupBy(*keys).agg(F.count(v).alias("non_null"), F.count_if(v.isNull()).alias("nulls"), F.bool_and(F.when(v.isNotNull(), v.rlike("^[0-9]+$"))).alias("digits"))
    filled = cells.where(v.isNotNull()).select(*keys, "position", "value")
    # Only the first thousand values of a field are numbered: each task hands on no more than so many, and sorts no others.
    first = Window.partitionBy(*keys).orderBy("position")
    head = filled.mapInArrow(lambda batches: _first_cells(batches, DISTINCT_HEAD), filled.schema).withColumn("k", F.row_number().over(first)).where(F.col("k") <= DISTINCT_HEAD)
    of = lambda n: F.col("k") <= n
    early = head.groupBy(*keys).agg(
        F.countDistinct(v).alias("distinct_seen"), F.max(F.when(of(100), F.length(v))).alias("len100"), F.min(F.when(of(100), F.length(v))).alias("short100"),
        F.countDistinct(F.when(of(50), v)).alias("distinct50"), F.countDistinct(F.when(of(100), v)).alias("distinct100"),
        F.bool_and(F.when(of(50), plain.rlike("^([0-9]{6}|[0-9]{8})$"))).alias("dates50"), F.bool_and(F.when(of(50), x.lenient_double(v).isNotNull())).alias("floats50"),
    )
    facts = counts.join(early, keys, "left").withColumn("distinct_seen", F.coalesce("distinct_seen", F.lit(0)))
    # A table of a task's distinct values would grow with the task, so equal values are counted a stretch at a time and meet after the
    # shuffle. Its number of parts is given, since small parts of well-packed values would be put together into large tables.
    spark = cells.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    types = {f.name: f.dataType.simpleString() for f in filled.schema}
    runs = filled.mapInArrow(_counted_cells, f"path {types['path']}, name {types['name']}, value {types['value']}, n long, at {types['position']}")
    seen = runs.repartition(parts, *keys, "value").groupBy(*keys, "value").agg(F.sum("n").alias("n"), F.min("at").alias("at"))
    best = Window.partitionBy(*keys).orderBy(F.desc("n"), "at")
    top = seen.withColumn("r", F.row_number().over(best)).where(F.col("r") <= TOP_VALUES)
    samples = top.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "value"))), lambda s: s["value"]).alias("samples"))
    s = {c: F.col(c) for c in ("digits", "len100", "short100", "distinct50", "distinct100", "dates50", "floats50")} | {"n": F.col("non_null")}
    upper = F.upper("name")
    hint = upper.startswith("DT") | upper.endswith("DATA") | F.substring(upper, 1, 3).contains("DT")
    kind = primitive_type(F.col("name"), s)
    signals = F.array_compact(
        F.array(F.when(hint & (kind != "empty"), "date_name_hint"), F.when(upper.startswith("CODMUN") & (kind != "empty"), "municipality_name_hint"), F.when(kind == "date", "date_value_hint"))
    )
    return facts.join(samples, keys, "left").select(*keys, kind.alias("primitive_type"), "non_null", "nulls", "distinct_seen", F.coalesce("samples", F.array().cast("array<string>")).alias("samples"), signals.alias("signals"))


def schema_signature(profiles: DataFrame) -> DataFrame:
    return profiles.groupBy("path").agg(codes.signature(F.sort_array(F.collect_list("name"))).alias("schema_signature"), F.count(F.lit(1)).alias("fields"))


def variable_catalog(profiles: DataFrame, members: DataFrame | None = None, per_list: int = 12) -> DataFrame:
    """One row per variable (upper case): families and files that have it, those families (``scopes``), its types, samples and signals by frequency.

    ``members`` maps ``path`` to ``family_id``, one path to any number of families.
    """
    rows = profiles.withColumn("variable", F.upper("name"))
    if members is not None:
        families = rows.join(members.select("path", "family_id").distinct(), "path", "left").groupBy("variable").agg(F.countDistinct("family_id").alias("family_count"), F.sort_array(F.collect_set("family_id")).alias("scopes"))
    else:
        families = rows.groupBy("variable").agg(F.lit(0).cast("long").alias("family_count"), F.any_value(F.array().cast("array<string>")).alias("scopes"))
    base = rows.groupBy("variable").agg(F.countDistinct("path").alias("file_count"))

    def ranked(value: Column, name: str, source: DataFrame) -> DataFrame:
        n = source.select("variable", value.alias("v")).groupBy("variable", "v").agg(F.count(F.lit(1)).alias("n"))
        order = Window.partitionBy("variable").orderBy(F.desc("n"), "v")
        few = n.withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_list)
        return few.groupBy("variable").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "v"))), lambda s: s["v"]).alias(name))

    types = ranked(F.col("primitive_type"), "primitive_types", rows)
    samples = ranked(F.col("s"), "samples", rows.withColumn("s", F.explode("samples")))
    lists = [types, samples]
    if "signals" in profiles.columns:
        lists.append(ranked(F.col("s"), "signals", rows.withColumn("s", F.explode("signals"))))
    return reduce(lambda a, b: a.join(b, "variable", "left"), lists, base.join(families, "variable"))


def jaccard_pairs(members: DataFrame, item: str, value: str, least: float = 0.0) -> DataFrame:
    """``a, b, shared, similarity`` of the items that share a value and are ``least`` or more alike, by an inverted index.

    With values in order from rare to frequent, two sets of similarity ``least`` or more share one of the first
    ``n - ceil(least * n) + 1`` values of each, so only those are joined: a value that most items have, which comes
    last, makes no pairs. Sizes bound the pairs as well, and pairs of short sets are judged where they meet, so only
    those that are alike are sent on. Pairs without a common value have similarity 0 and no row.
    """
    each = members.select(F.col(item).alias("i"), F.col(value).alias("v")).where("i is not null and v is not null").distinct()
    often = each.groupBy("v").agg(F.count(F.lit(1)).alias("f"))
    sets = each.join(often, "v").groupBy("i").agg(F.sort_array(F.collect_list(F.struct("f", "v"))).alias("s"))
    sets = sets.select("i", F.transform("s", lambda e: e["v"]).alias("s"), F.size("s").alias("n"))
    reach = F.col("n") - F.greatest(F.ceil(F.col("n") * F.lit(least) - 1e-9), F.lit(1)).cast("int") + 1
    index = sets.select("i", "n", F.when(F.col("n") <= SHORT_SET, F.col("s")).alias("s"), F.posexplode(F.slice("s", 1, reach)).alias("at", "v"))
    l, r = index.alias("l"), index.alias("r")
    sized = F.least("l.n", "r.n") >= F.lit(least) * F.greatest("l.n", "r.n") - 1e-9
    # What two sets must have in common; from their first common value on, they have no more than the rest of each.
    needed = F.lit(least / (1 + least)) * (F.col("l.n") + F.col("r.n")) - 1e-9
    room = F.least(F.col("l.n") - F.col("l.at"), F.col("r.n") - F.col("r.at")) >= needed
    alike = F.when(F.col("l.s").isNull() | F.col("r.s").isNull(), True).otherwise(F.size(F.array_intersect("l.s", "r.s")) >= needed)
    met = l.join(r, (F.col("l.v") == F.col("r.v")) & (F.col("l.i") < F.col("r.i")) & sized & room & alike).select(F.col("l.i").alias("a"), F.col("r.i").alias("b")).distinct()
    side = lambda s: sets.select(F.col("i").alias(s), F.col("s").alias(f"s{s}"))
    both = met.join(side("a"), "a").join(side("b"), "b").withColumn("shared", F.size(F.array_intersect("sa", "sb")).cast("long"))
    out = both.withColumn("similarity", F.col("shared") / (F.size("sa") + F.size("sb") - F.col("shared")))
    return out.where(F.col("similarity") >= least).select("a", "b", "shared", "similarity")


def family_clusters(members: DataFrame, item: str, value: str, threshold: float = 0.8) -> DataFrame:
    """``node, component``: items chained by similarities of ``threshold`` or more."""
    items = members.select(F.col(item).alias("node")).where("node is not null").distinct()
    return connected_components(items, jaccard_pairs(members, item, value, threshold).select("a", "b"))


def variable_pairs(profiles: DataFrame, members: DataFrame, clusters: DataFrame, by_name: float = 0.85, by_value: float = 0.6) -> DataFrame:
    """``component, a, b, name_similarity, value_similarity`` of variables of a family cluster that no family has both of and whose
    names and frequent values are alike.

    ``profiles`` has ``path, name, samples``, ``members`` ``path, family_id``, ``clusters`` ``node, component``. A variable's values are
    the samples of all its fields, a dozen each. Pairs are made where values are shared; the name ratio, the slow part, comes last.
    """
    fields = profiles.join(members.select("path", "family_id").distinct(), "path").join(clusters.select(F.col("node").alias("family_id"), "component"), "family_id")
    fields = fields.withColumn("variable", F.upper("name")).where("variable != ''")
    held = fields.groupBy("component", "variable").agg(F.collect_set("family_id").alias("families"), F.array_distinct(F.flatten(F.collect_list("samples"))).alias("space"))
    pieces = held.select("component", "variable", F.explode("space").alias("piece"))
    l, r = pieces.alias("l"), pieces.alias("r")
    near = l.join(r, (F.col("l.component") == F.col("r.component")) & (F.col("l.piece") == F.col("r.piece")) & (F.col("l.variable") < F.col("r.variable")))
    near = near.select(F.col("l.component").alias("component"), F.col("l.variable").alias("a"), F.col("r.variable").alias("b")).distinct()
    side = lambda s: held.select("component", F.col("variable").alias(s), F.col("families").alias(f"f{s}"), F.col("space").alias(f"s{s}"), x.name_key(F.col("variable")).alias(f"k{s}"))
    both = near.join(side("a"), ["component", "a"]).join(side("b"), ["component", "b"]).where(~F.arrays_overlap("fa", "fb"))
    alike = both.withColumn("value_similarity", x.jaccard(F.col("sa"), F.col("sb"))).where(F.col("value_similarity") >= by_value)
    scored = alike.withColumn("name_similarity", x.sequence_ratio("ka", "kb")).where(F.col("name_similarity") >= by_name)
    return scored.select("component", "a", "b", F.round("name_similarity", 4).alias("name_similarity"), F.round("value_similarity", 4).alias("value_similarity"))


def variable_clusters(pairs: DataFrame, profiles: DataFrame, members: DataFrame, clusters: DataFrame) -> DataFrame:
    """Variables chained by ``variable_pairs`` within a family cluster: ``component, variables, families, strongest_name_similarity, strongest_value_similarity``."""
    node = lambda v: F.concat_ws("\x01", "component", v)
    ends = pairs.select("component", F.explode(F.array("a", "b")).alias("variable")).distinct()
    parts = connected_components(ends.select(node("variable").alias("node")), pairs.select(node("a").alias("a"), node("b").alias("b"))).withColumnRenamed("component", "part")
    placed = ends.withColumn("node", node("variable")).join(parts, "node").select("component", "variable", "part")
    has = profiles.select("path", F.upper("name").alias("variable")).join(members.select("path", "family_id").distinct(), "path").join(clusters.select(F.col("node").alias("family_id"), "component"), "family_id")
    wide = placed.join(has.select("component", "variable", "family_id").distinct(), ["component", "variable"]).groupBy("component", "part").agg(F.sort_array(F.collect_set("variable")).alias("variables"), F.sort_array(F.collect_set("family_id")).alias("families"))
    strong = pairs.join(placed.withColumnRenamed("variable", "a"), ["component", "a"]).groupBy("component", "part").agg(F.max("name_similarity").alias("strongest_name_similarity"), F.max("value_similarity").alias("strongest_value_similarity"))
    return wide.join(strong, ["component", "part"]).drop("part")
