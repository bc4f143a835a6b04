"""Compilation of canonical records into observables: counts, code counts, threshold counts, shrunk rates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import CodeQuery


@dataclass(frozen=True)
class Observable:
    """Cells (support, subgroups, ``value``) and what they are."""

    cells: DataFrame
    family: str
    measure: str
    representation: str
    grain: list[str]
    lineage: dict = field(default_factory=dict)
    uncertainty: dict = field(default_factory=dict)

    def header(self, records: DataFrame, order: str = "provenance.row") -> DataFrame:
        """One row: the first support role by ``order`` that is not blank, and the source systems, of the records compiled."""
        role = F.nullif("support_role", F.lit(""))
        return records.agg(
            F.coalesce(F.min_by(role, F.when(role.isNotNull(), F.col(order))), F.lit("unknown")).alias("support_role"),
            F.sort_array(F.collect_set(F.coalesce("source.system", F.lit("")))).alias("sources"),
        )


def _key(name: str, kind: str) -> Column:
    if kind == "support":
        return F.col("support").getField(name).alias(name)
    return F.try_element_at("subgroups", F.lit(name)).alias(name)


def counts(records: DataFrame, *, family: str, support: Sequence[str], subgroups: Sequence[str] = (), exclude: bool = False) -> Observable:
    """Sum of weights by support and subgroup, null keys being keys.

    As in the source data model the quality flag does not filter unless ``exclude`` is set.
    """
    keys = [_key(k, "support") for k in support] + [_key(k, "subgroup") for k in subgroups]
    used = records.where(F.col("quality.included")) if exclude else records
    cells = used.select(*keys, F.col("weight").cast("double").alias("weight")).groupBy(*support, *subgroups).agg(F.sum("weight").alias("value"))
    return Observable(cells, family, "count", "extensive", list(support), {"compiler": "counts"}, {"count_model": "poisson"})


def code_counts(records: DataFrame, query: CodeQuery, *, family: str, support: Sequence[str], subgroups: Sequence[str] = ()) -> Observable:
    """Counts of records with a matching code in the role's slots or in any annotation: once a record, however many slots match."""
    slots = F.coalesce(F.try_element_at("code_roles", F.lit(query.role)), F.array().cast("array<string>"))
    noted = F.coalesce(F.flatten(F.map_values("annotations")), F.array().cast("array<string>"))
    out = counts(records.where(query.any_of(slots) | query.any_of(noted)), family=family, support=support, subgroups=subgroups)
    return replace(out, lineage={"compiler": "code_counts", "query": query})


def threshold_counts(records: DataFrame, field_name: str, predicate: Callable[[Column], Column], *, family: str, support: Sequence[str], subgroups: Sequence[str] = ()) -> Observable:
    """Counts of records whose continuous attribute meets a condition; a missing one does not."""
    met = F.coalesce(predicate(F.try_element_at("continuous", F.lit(field_name))), F.lit(False))
    return counts(records.where(met), family=family, support=support, subgroups=subgroups)


def rates(numerator: Observable, denominator: DataFrame, *, family: str, alpha: float = 0.5, beta: float = 0.5, order: str | None = None) -> Observable:
    """(n + alpha) / (d + alpha + beta) over cells that both sides have.

    Keys are the numerator's columns but ``value``; null keys match each other. Cells
    without a positive denominator drop out. Of several denominators of a cell the last
    by the column ``order`` counts; without one they must be unique, or the query fails.
    """
    keys = [c for c in numerator.cells.columns if c != "value"]
    only = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("several denominators for one cell: name the column that orders them"))).otherwise(F.max("value"))
    bottom = denominator.groupBy(*keys).agg((F.max_by("value", order) if order else only).cast("double").alias("denominator"))
    on = [F.col(f"n.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys]
    joined = numerator.cells.alias("n").join(bottom.where("denominator > 0").alias("d"), on)
    shrunk = (F.col("n.value") + alpha) / (F.col("d.denominator") + alpha + beta)
    cells = joined.select(*[F.col(f"n.{k}") for k in keys], F.col("d.denominator").cast("double").alias("denominator"), shrunk.alias("value"))
    return Observable(cells, family, "rate", "shrunk_rate", numerator.grain, {**numerator.lineage, "compiler": "rates"}, {"alpha": alpha, "beta": beta})


def multigrain(records: DataFrame, grains: Sequence[Sequence[str]], *, support: Sequence[str], subgroups: Sequence[str] = ()) -> DataFrame:
    """Counts at several grains in one pass; ``grain`` is Spark's grouping id over support, then subgroups."""
    names = [*support, *subgroups]
    keyed = records.select(*[_key(k, "support") for k in support], *[_key(k, "subgroup") for k in subgroups], "weight")
    sets = [[F.col(c) for c in g] for g in grains]
    return keyed.groupingSets(sets, *[F.col(c) for c in names]).agg(F.grouping_id().alias("grain"), F.sum("weight").alias("value"))


def validation(records: DataFrame) -> DataFrame:
    """Adds ``valid, errors, warnings``."""
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    errors = F.array_compact(F.array(F.when(blank("support_role"), "missing_support_role"), F.when(blank("event_type"), "missing_event_type")))
    warnings = F.array_compact(
        F.array(
            F.when(F.col("support.municipality").isNull(), "missing_support_municipality"),
            F.when(~F.coalesce("quality.included", F.lit(False)), "record_marked_excluded"),
        )
    )
    return records.withColumns({"errors": errors, "warnings": warnings}).withColumn("valid", F.size("errors") == 0)


def intensive_rollup(cells: DataFrame, by: Sequence[str], exposure: str = "denominator") -> DataFrame:
    """Exposure-weighted mean of an intensive value over coarser cells (extension)."""
    return cells.groupBy(*by).agg((F.sum(F.col(exposure) * F.col("value")) / F.sum(exposure)).alias("value"), F.sum(exposure).alias(exposure))


def extensive_rollup(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sum of an extensive value over coarser cells (extension)."""
    return cells.groupBy(*by).agg(F.sum("value").alias("value"))


def contextual_clone(cells: DataFrame, context: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every cell with the context of its coarser unit (extension)."""
    return cells.join(context, list(on), "left")


def gamma_poisson(observed: Column, expected: Column, alpha: float = 0.5, beta: float = 0.5) -> Column:
    """(Y + alpha) / (E + beta) (extension)."""
    return (observed + alpha) / (expected + beta)
