"""Translation of coded values by a registry of variables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.grammar import KINDS, Entry


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


#: Rules that change a value; any other name leaves it as it is.
RULES = {
    "ibge6": lambda c: F.substring(_digits(c), 1, 6),
    "ibge7": lambda c: F.substring(_digits(c), 1, 7),
    "cid10": lambda c: F.replace(F.upper(c), F.lit("."), F.lit("")),
    "date8": lambda c: F.when(F.length(_digits(c)) == 8, _digits(c)).otherwise(c),
}


def translate_value(value: Column, entry: Entry | None) -> Column:
    """Categories by their map, an unmapped one as it is; other kinds by their rules in order; blank is null; no entry, no change."""
    if entry is None:
        return value
    raw = F.nullif(F.trim(value.cast("string")), F.lit(""))
    if entry.kind == "cat":
        if not entry.value_map:
            return raw
        table = F.create_map(*[F.lit(x) for kv in entry.value_map.items() for x in kv])
        return F.coalesce(F.try_element_at(table, raw), raw)
    for rule in entry.rules:
        raw = F.nullif(F.trim(RULES.get(rule, lambda c: c)(raw)), F.lit(""))
    return raw


def translate_columns(rows: DataFrame, entries: list[Entry], scope: str | None = None) -> DataFrame:
    """Every column by the entry that its name resolves to; one projection."""
    return rows.select(*[translate_value(F.col(c), resolve_entry(entries, c, scope)).alias(c) for c in rows.columns])


def resolve_entry(entries: list[Entry], variable: str, scope: str | None = None) -> Entry | None:
    """Scope and name, scope and alias, global name, global alias; later entries win; a scoped entry's aliases count as global too."""
    name = variable.upper()
    best: tuple[int, Entry] | None = None
    for e in entries:
        own, alias = e.variable.upper() == name, name in [a.upper() for a in e.aliases]
        scoped = scope is not None and e.scope.upper() == scope.upper()
        everywhere = e.scope.upper() == "GLOBAL"
        rank = 0 if scoped and own else 1 if scoped and alias else 2 if everywhere and own else 3 if alias else None
        if rank is not None and (best is None or rank <= best[0]):
            best = rank, e
    return best and best[1]


def resolve(variables: DataFrame, registry: DataFrame) -> DataFrame:
    """Adds ``label, kind`` of the entry for (``scope``, ``variable``) by the same priorities, as one join.

    ``registry``: ``scope, variable, kind, label, aliases, pos``.
    """
    up = registry.select(F.upper("scope").alias("rs"), F.upper("variable").alias("name"), "kind", "label", "pos", F.lit(0).alias("by"), "aliases")
    alias = up.select("rs", F.explode(F.transform("aliases", lambda a: F.upper(a))).alias("name"), "kind", "label", "pos", F.lit(1).alias("by"))
    keys = up.drop("aliases").unionByName(alias)
    wide = keys.unionByName(alias.where("rs != 'GLOBAL'").withColumn("rs", F.lit("GLOBAL")))
    v = variables.select("scope", "variable").distinct().withColumn("vs", F.upper(F.coalesce("scope", F.lit("GLOBAL"))))
    hits = v.join(wide, (F.upper("variable") == F.col("name")) & F.col("rs").isin("GLOBAL") | ((F.upper("variable") == F.col("name")) & (F.col("vs") == F.col("rs"))))
    rank = F.when(F.col("rs") == F.col("vs"), F.col("by")).otherwise(F.col("by") + 2)
    best = Window.partitionBy("scope", "variable").orderBy(rank, F.desc("pos"))
    top = hits.withColumn("r", F.row_number().over(best)).where("r = 1").select(F.col("scope").alias("_scope"), F.col("variable").alias("_variable"), "kind", "label")
    return variables.join(top, (F.col("variable") == F.col("_variable")) & F.col("scope").eqNullSafe(F.col("_scope")), "left").drop("_scope", "_variable")


def coverage(variables: DataFrame, registry: DataFrame, scopes: list[str] | None = None) -> DataFrame:
    """``covered, n, variables`` over distinct upper-case names that are not blank: whether an entry resolves in one of the scopes or globally."""
    names = variables.select(F.upper(F.trim("variable")).alias("variable")).where("variable != ''").distinct()
    tried = F.array(F.lit(None).cast("string"), *[F.lit(s) for s in scopes or [] if s])
    out = resolve(names.withColumn("scope", F.explode(tried)), registry).groupBy("variable").agg(F.max(F.col("kind").isNotNull()).alias("covered"))
    return out.groupBy("covered").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_list("variable")), ",").alias("variables"))


def merge(registries: list[DataFrame]) -> DataFrame:
    """Later registries win by (scope, variable), case aside."""
    parts = [r.withColumn("_source", F.lit(i)) for i, r in enumerate(registries)]
    union = parts[0]
    for more in parts[1:]:
        union = union.unionByName(more)
    last = Window.partitionBy(F.upper("scope"), F.upper("variable")).orderBy(F.desc("_source"), F.desc("pos"))
    return union.withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r", "_source")


def lint(registry: DataFrame) -> DataFrame:
    """``scope, variable, errors, warnings``."""
    twice = F.count(F.lit(1)).over(Window.partitionBy(F.upper("scope"), F.upper("variable"))) > 1
    has_map = F.size(F.map_keys("value_map")) > 0
    errors = F.array(F.when(twice, "duplicate_key"), F.when(~F.col("kind").isin(*KINDS), "unknown_kind"), F.when(F.trim(F.coalesce("label", F.lit(""))) == "", "empty_label"))
    warnings = F.array(F.when((F.col("kind") == "cat") & ~has_map, "cat_without_value_map"), F.when((F.col("kind") != "cat") & has_map, "value_map_on_other_kind"))
    return registry.select("scope", "variable", F.array_compact(errors).alias("errors"), F.array_compact(warnings).alias("warnings"))
