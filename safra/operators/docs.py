"""Documents that describe data series: relevance scores and token overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as p
from ..functions import text as x
from .graph import cut

THRESHOLD = 60.0
REACH = 4


def ancestors(parts: Column, reach: int = REACH) -> Column:
    """The directory itself and those above it, ``reach`` steps at most: structs ``ancestor, up``."""
    ups = F.sequence(F.lit(0), F.least(F.size(parts), F.lit(reach)))
    return F.transform(ups, lambda k: F.struct(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - k), "/").alias("ancestor"), k.alias("up")))


def near_directories(left: DataFrame, right: DataFrame, reach: int = REACH) -> DataFrame:
    """``a, b, distance`` of the directories (columns ``directory``) that are ``reach`` steps apart at most.

    Both sides are indexed by their ancestors with the steps up to them, and meet where those steps sum to ``reach`` or
    less; the least sum is at the deepest common ancestor. A directory with all others below it is met from near only.
    """

    def index(side: DataFrame, name: str) -> DataFrame:
        own = side.select(F.col("directory").alias(name)).where(F.col(name).isNotNull()).distinct()
        return own.select(name, F.explode(ancestors(p.components(F.col(name)), reach)).alias("_e")).select(name, F.col("_e.ancestor").alias("ancestor"), F.col("_e.up").alias(f"_{name}"))

    met = index(left, "a").join(index(right, "b"), "ancestor").where(F.col("_a") + F.col("_b") <= reach)
    return met.groupBy("a", "b").agg(F.min(F.col("_a") + F.col("_b")).alias("distance"))


def has_word(name: Column) -> Column:
    """Whether a lower-case name holds a word of reference documents."""
    return name.rlike("|".join(p.REFERENCE_WORDS))


def associate(series: DataFrame, files: DataFrame, threshold: float = THRESHOLD, reach: int = REACH) -> DataFrame:
    """``series, url, distance, bonus, score`` of the PDFs (``url``: paths) near a series (``series, source_path``, and ``name`` if that differs).

    Score: .35 proximity + .25 name likeness + .40 context likeness, 25 more for a reference word in the name; the best over
    a series' paths, ``threshold`` or more, with the distance it has there. Places more than ``reach`` steps apart score
    nothing, and are never paired: directories meet by their ancestors, and only then series and documents.
    """
    pdfs = files.where(F.lower("url").endswith(".pdf")).select("url").distinct()
    name = F.lower(F.regexp_replace(p.file_name(F.col("url")), r"\.[^.]*$", ""))
    tail = lambda parts: F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), " ")
    pdfs = cut(pdfs.select("url", p.directory(F.col("url")).alias("b"), name.alias("name")))
    called = F.col("name" if "name" in series.columns else "series").alias("called")
    data = cut(series.select("series", called, F.col("source_path").alias("a")).where("series is not null and a is not null and a != ''").distinct())
    near = near_directories(data.select(F.col("a").alias("directory")), pdfs.select(F.col("b").alias("directory")), reach)
    # Pairs are many to a byte read: dealt out by number, as few large tasks would otherwise compare them all.
    both = near.join(data, "a").join(pdfs, "b").repartition(4 * files.sparkSession.sparkContext.defaultParallelism, "series", "url")
    by_path = x.token_set_ratio(F.lower(F.concat_ws(" ", "called", tail(p.components(F.col("a"))))), F.lower(F.concat_ws(" ", "name", tail(p.components(F.col("b"))))))
    bonus = F.when(has_word(F.col("name")), 25).otherwise(0)
    near_ = 0.35 * F.greatest(F.lit(0), 100 - 20 * F.col("distance"))
    rated = lambda by_name, by_path: near_ + 0.25 * by_name + 0.40 * by_path + F.col("bonus")
    # Name likeness, the slow part, comes last, and only where full marks for it could reach the threshold; elsewhere it is null.
    full, floor = F.lit(100.0), threshold - 1e-6
    some = both.withColumn("bonus", bonus).where(rated(full, full) >= floor).withColumn("by_path", by_path)
    likeness = some.withColumn("by_name", x.partial_ratio(F.when(rated(full, F.col("by_path")) >= floor, F.lower("called")), F.col("name")))
    best = likeness.withColumn("score", rated(F.col("by_name"), F.col("by_path"))).groupBy("series", "url").agg(F.max(F.struct("score", (-F.col("distance")).alias("near"), "bonus")).alias("_b"))
    told = best.select("series", "url", (-F.col("_b.near")).alias("distance"), F.col("_b.bonus").alias("bonus"), F.col("_b.score").alias("score"))
    return told.where(F.col("score") >= threshold).withColumn("score", F.bround("score", 2))


# Words of documents that describe a whole system; scores and list lengths of the two tiers.
GENERIC_HINTS = ["TAB", "TABS", "TABWIN", "DICIONARIO", "DIC", "LAYOUT", "MANUAL", "ESTRUTURA", "INFORME", "NOTA", "DOCS"]
SPECIFIC = {"base": 60, "subsystem": 20, "prefix": 20, "word": 6, "words": 18, "most": 12}
GENERIC = {"base": 35, "word": 4, "words": 12, "most": 6}
LEAST_PREFIX = 3


def associate_by_words(families: DataFrame, docs: DataFrame) -> DataFrame:
    """``family_id, url, match_tier, score, rank``: the documents of a family's system that tell of it, in two tiers.

    ``families``: ``family_id, system, subsystem, prefix, source_paths``; ``docs``: ``url, filename, directory, system,
    subsystem, keyword_hits`` (an array). Family-specific: the same subsystem, the prefix (three letters or more) among the
    document's words, or two common words; else system-generic, with a word or a keyword of general documents. A family
    keeps the 12 and 6 best by score, then file name, then url. Names of systems compare in upper case.

    Words, subsystems and ranks are joined, each by equality: a general document of a system meets a family by its rank in
    file-name order, up to as many ranks as the family needs, so no family is paired with all documents of its system.
    """
    up = lambda c: F.upper(F.coalesce(c, F.lit("")))
    prefix = up(F.col("prefix"))
    own = F.array_distinct(F.flatten(F.array(x.tokens(up(F.col("subsystem"))), F.when(F.length(prefix) >= LEAST_PREFIX, F.array(prefix)).otherwise(F.array().cast("array<string>")), F.flatten(F.transform(F.coalesce("source_paths", F.array().cast("array<string>")), lambda q: x.tokens(p.file_name(q)))))))
    fam = cut(families.select("family_id", up(F.col("system")).alias("system"), up(F.col("subsystem")).alias("sub"), F.when(F.length(prefix) >= LEAST_PREFIX, prefix).alias("prefix"), own.alias("words")))
    words = F.array_distinct(F.concat(x.tokens(p.stem(F.coalesce("filename", F.lit("")))), x.tokens(F.coalesce("directory", F.lit("")))))
    told = docs.select("url", F.coalesce("filename", F.lit("")).alias("filename"), up(F.col("system")).alias("system"), up(F.col("subsystem")).alias("sub"), words.alias("words"), (F.size(F.coalesce("keyword_hits", F.array().cast("array<string>"))) > 0).alias("hit"))
    told = cut(told.withColumn("generic", F.col("hit") | F.arrays_overlap("words", F.array(*[F.lit(w) for w in GENERIC_HINTS]))).drop("hit"))

    by_word = fam.select("family_id", "system", F.explode("words").alias("word")).join(told.select("url", "system", F.explode("words").alias("word")), ["system", "word"])
    by_word = by_word.groupBy("family_id", "url").agg(F.count(F.lit(1)).alias("overlap"))
    by_prefix = fam.where("prefix is not null").select("family_id", "system", F.col("prefix").alias("word")).join(told.select("url", "system", F.explode("words").alias("word")), ["system", "word"]).select("family_id", "url", F.lit(1).alias("by_prefix"))
    by_sub = fam.where("sub != ''").select("family_id", "system", "sub").join(told.select("url", "system", "sub"), ["system", "sub"]).select("family_id", "url", F.lit(1).alias("by_sub"))
    met = by_word.join(by_prefix, ["family_id", "url"], "full").join(by_sub, ["family_id", "url"], "full").na.fill(0)
    met = met.join(told.select("url", "filename", "generic"), "url")
    specific = (F.col("by_sub") > 0) | (F.col("by_prefix") > 0) | (F.col("overlap") >= 2)
    met = cut(met.where(specific | F.col("generic")).withColumn("specific", specific))
    s, g = SPECIFIC, GENERIC
    points = s["base"] + s["subsystem"] * F.col("by_sub") + s["prefix"] * F.col("by_prefix") + F.least(F.col("overlap") * s["word"], F.lit(s["words"]))
    close = met.where("specific").select("family_id", "url", "filename", F.lit("family_specific").alias("match_tier"), points.cast("int").alias("score"))
    loose = met.where("not specific").select("family_id", "url", "filename", F.lit("system_generic").alias("match_tier"), (g["base"] + F.least(F.col("overlap") * g["word"], F.lit(g["words"]))).cast("int").alias("score"))

    # General documents without a common word: by rank in their system, past those already met.
    general = told.where("generic").withColumn("nth", F.row_number().over(Window.partitionBy("system").orderBy("filename", "url")))
    passed = met.where("generic").groupBy("family_id").agg(F.count(F.lit(1)).alias("passed"))
    due = fam.select("family_id", "system").join(passed, "family_id", "left").withColumn("nth", F.explode(F.sequence(F.lit(1), (F.coalesce("passed", F.lit(0)) + g["most"]).cast("int"))))
    rest = due.join(general.select("system", "nth", "url", "filename"), ["system", "nth"]).join(met.select("family_id", "url"), ["family_id", "url"], "left_anti")
    rest = rest.select("family_id", "url", "filename", F.lit("system_generic").alias("match_tier"), F.lit(g["base"]).alias("score"))
    rank = F.row_number().over(Window.partitionBy("family_id", "match_tier").orderBy(F.desc("score"), "filename", "url"))
    ranked = close.unionByName(loose).unionByName(rest).withColumn("rank", rank)
    most = F.when(F.col("match_tier") == "family_specific", s["most"]).otherwise(g["most"])
    return ranked.where(F.col("rank") <= most).select("family_id", "url", "match_tier", "score", "rank")


def token_overlap(families: DataFrame, documents: DataFrame, family: str, document: str, least: int = 1) -> DataFrame:
    """``family, document, overlap`` of those that share ``least`` words or more.

    With the words in order from rare to frequent among the documents, two sets with ``least`` common words share one that is
    not among the last ``least - 1`` of either, so the most frequent words of a set pair nothing; the overlap is counted over
    the whole sets of the pairs found.
    """
    often = documents.select("word", document).distinct().groupBy("word").agg(F.count(F.lit(1)).alias("_f"))

    def sets(side: DataFrame, key: str) -> DataFrame:
        each = side.where(F.col("word").isNotNull()).select(key, "word").distinct().join(often, "word")
        held = each.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_f", "word"))).alias("_s"))
        return cut(held.select(key, F.transform("_s", lambda e: e["word"]).alias(f"_{key}")).where(F.size(f"_{key}") >= least))

    f, d = sets(families, family), sets(documents, document)
    index = lambda side, key: side.select(key, F.explode(F.slice(f"_{key}", F.lit(1), F.size(f"_{key}") - (least - 1))).alias("word"))
    met = index(f, family).join(index(d, document), "word").select(family, document).distinct()
    counted = met.join(f, family).join(d, document).withColumn("overlap", F.size(F.array_intersect(f"_{family}", f"_{document}")).cast("long"))
    return counted.where(F.col("overlap") >= least).select(family, document, "overlap")


def matched(docs: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The documents that some family has; ``known`` has their keys."""
    return docs.join(known.select(key).distinct(), key, "left_semi")


def orphans(docs: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The documents that no family has."""
    return docs.join(known.select(key).distinct(), key, "left_anti")


def pdf_audit(files: DataFrame, matched: DataFrame, endpoint: str, most: int = 100, listed: int = 200) -> DataFrame:
    """The PDFs below an endpoint against those that some family is associated with: ``section, item, n, rank``.

    ``files`` has ``path, url``, ``matched`` the ``url`` of associated documents. Sections: ``count`` (pdfs, matched, orphans,
    likely_reference_orphans), ``top_level`` (50), ``directory`` and ``orphan_directory`` (``most``) by count, ``orphan`` and
    ``likely_reference_orphan`` (``listed`` urls in order). Directories of equal counts rank by name.
    """
    path = F.col("path")
    below = p.components(F.lit(endpoint))
    rows = files.where(F.lower("path").endswith(".pdf") & p.under(path, endpoint)).select("path", "url").distinct()
    rest = F.slice(p.components(path), F.size(below) + 1, F.size(p.components(path)))
    told = rows.select("url", p.directory(path).alias("directory"), F.coalesce(F.try_element_at(rest, F.lit(1)), F.lit("(endpoint_root)")).alias("top"), p.is_reference_pdf(p.file_name(path), p.directory(path)).alias("reference"))
    known = matched.select(F.col("url").alias("_url")).where("_url != ''").distinct()
    told = cut(told.join(known, told["url"] == known["_url"], "left").withColumn("orphan", F.col("_url").isNull()).drop("_url"))
    totals = told.agg(F.count(F.lit(1)).alias("pdfs"), F.count_if(~F.col("orphan")).alias("matched"), F.count_if("orphan").alias("orphans"), F.count_if(F.col("orphan") & F.col("reference")).alias("likely_reference_orphans"))
    names = ["pdfs", "matched", "orphans", "likely_reference_orphans"]
    out = totals.select(F.explode(F.array(*[F.struct(F.lit(n).alias("item"), F.col(n).alias("n")) for n in names])).alias("e")).select(F.lit("count").alias("section"), "e.item", "e.n", F.lit(None).cast("int").alias("rank"))

    def tops(rows_: DataFrame, section: str, key: str, limit: int) -> DataFrame:
        n = rows_.groupBy(F.col(key).alias("item")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "item").limit(limit)
        return n.select(F.lit(section).alias("section"), "item", "n", F.row_number().over(Window.orderBy(F.desc("n"), "item")).alias("rank"))

    def first(rows_: DataFrame, section: str) -> DataFrame:
        some = rows_.select("url").orderBy("url").limit(listed)
        return some.select(F.lit(section).alias("section"), F.col("url").alias("item"), F.lit(None).cast("long").alias("n"), F.row_number().over(Window.orderBy("url")).alias("rank"))

    orphans = told.where("orphan")
    for part in (tops(told, "top_level", "top", 50), tops(told, "directory", "directory", most), tops(orphans, "orphan_directory", "directory", most), first(orphans, "orphan"), first(orphans.where("reference"), "likely_reference_orphan")):
        out = out.unionByName(part)
    return out
