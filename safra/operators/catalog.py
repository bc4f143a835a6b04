"""A catalogue of statistical tables: shredding metadata, links, coverage, search, values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import periods as t
from ..functions import text as x
from ..plans import boolean

_PAYLOAD = "array<map<string,string>>"
METADATA = """struct<id:long,nome:string,pesquisa:string,assunto:string,url:string,
periodicidade:struct<frequencia:string,inicio:string,fim:string>,
nivelTerritorial:map<string,array<string>>, variaveis:array<struct<id:string,nome:string,unidade:string>>,
classificacoes:array<struct<id:string,nome:string,categorias:array<struct<id:string,nome:string,unidade:string,nivel:long>>>>>"""


def shred(payloads: DataFrame) -> dict[str, DataFrame]:
    """Catalogue tables from one JSON text per table in ``payload``."""
    m = payloads.select(F.from_json("payload", METADATA).alias("m")).select("m.*").where("id is not null")
    own = F.col("id").alias("agregado_id")
    classes = m.select(own, F.explode("classificacoes").alias("c"))
    return {
        "agregados": m.select("id", "nome", "pesquisa", "assunto", "url", F.col("periodicidade.frequencia").alias("freq"), F.col("periodicidade.inicio").alias("periodo_inicio"), F.col("periodicidade.fim").alias("periodo_fim")),
        "variables": m.select(own, F.explode("variaveis").alias("v")).select("agregado_id", "v.*"),
        "classifications": classes.select("agregado_id", "c.id", "c.nome"),
        "categories": classes.select("agregado_id", F.col("c.id").alias("classification_id"), F.explode("c.categorias").alias("k")).select("agregado_id", "classification_id", "k.*"),
        "agregados_levels": m.select(own, F.explode(F.flatten(F.map_values("nivelTerritorial"))).alias("level_id")).distinct(),
    }


def links(items: DataFrame, *keys: str) -> DataFrame:
    """``name_key`` of ``nome`` with the keys, each once; blank names link nothing."""
    return items.select(x.normalize_basic(F.col("nome")).alias("name_key"), *keys).where("name_key != ''").dropDuplicates()


def category_links(categories: DataFrame, classifications: DataFrame) -> DataFrame:
    """Categories by their name and their classification's; those of a blank or missing classification drop out."""
    c = classifications.select("agregado_id", F.col("id").alias("classification_id"), x.normalize_basic(F.col("nome")).alias("class_key")).where("class_key != ''")
    k = categories.select("agregado_id", "classification_id", F.col("id").alias("category_id"), x.normalize_basic(F.col("nome")).alias("name_key"))
    return k.join(c, ["agregado_id", "classification_id"]).select("class_key", "name_key", "agregado_id", "category_id").dropDuplicates()


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The old rows whose key the new ones lack, and the new ones."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def level_counts(levels: DataFrame) -> DataFrame:
    """``agregado_id, counts``: a map from level to its number of localities."""
    pairs = F.collect_list(F.struct(F.upper("level_id").alias("k"), F.coalesce("locality_count", F.lit(0)).cast("long").alias("v")))
    return levels.groupBy("agregado_id").agg(F.map_from_entries(F.sort_array(pairs)).alias("counts"))


def covered(levels: DataFrame, expression: str) -> DataFrame:
    """The tables whose level counts satisfy a coverage expression."""
    truth, _ = boolean.compile_node(boolean.parse(expression, texts=False), F.col("counts"), {})
    return level_counts(levels).where(truth)


def contexts(catalog: dict[str, DataFrame]) -> DataFrame:
    """One row per table with what searches look at: normalised texts and level counts."""

    def names(df: DataFrame, as_: str, shown: Column | None = None) -> DataFrame:
        return df.groupBy("agregado_id").agg(F.collect_set(shown if shown is not None else x.normalize_basic(F.col("nome"))).alias(as_))

    kinds = catalog["classifications"].select("agregado_id", F.col("id").alias("classification_id"), x.normalize_basic(F.col("nome")).alias("_class"))
    cats = catalog["categories"].join(kinds, ["agregado_id", "classification_id"])
    head = catalog["agregados"].select(F.col("id").alias("agregado_id"), "nome", "periodo_inicio", "periodo_fim", *[F.array(x.normalize_basic(F.col(c))).alias(n) for c, n in (("nome", "TITLE"), ("pesquisa", "SURVEY"), ("assunto", "SUBJECT"))])
    parts = [names(catalog["variables"], "VAR"), names(catalog["classifications"], "CLASS"), names(cats, "CAT", F.concat_ws("::", "_class", x.normalize_basic(F.col("nome")))), level_counts(catalog["agregados_levels"])]
    for part in parts:
        head = head.join(part, "agregado_id", "left")
    none = F.create_map().cast("map<string,bigint>")
    return head.withColumn("counts", F.coalesce("counts", none)).withColumns({f: F.coalesce(f, F.array().cast("array<string>")) for f in ("VAR", "CLASS", "CAT")})


def search(contexts_: DataFrame, expression: str | None, limit: int = 20) -> DataFrame:
    """Tables that satisfy a where-expression, by score (reasons, and one more for municipal data), then id."""
    truth, why = F.lit(True), F.array().cast("array<string>")
    if expression:
        truth, why = boolean.compile_node(boolean.parse(expression), F.col("counts"), {f: F.col(f) for f in boolean.FIELDS})
    level = lambda n: F.coalesce(F.try_element_at("counts", F.lit(n)), F.lit(0))
    hits = contexts_.where(truth).select(F.col("agregado_id").alias("table_id"), F.col("nome").alias("title"), "periodo_inicio", "periodo_fim", level("N3").alias("n3"), level("N6").alias("n6"), why.alias("why"))
    return hits.withColumn("score", (F.size("why") + (F.col("n6") != 0).cast("int")).cast("double")).orderBy(F.desc("score"), "table_id").limit(limit)


def payload_rows(payloads: DataFrame) -> DataFrame:
    """Value rows from ``aggregate_id, variable_id, payload`` (a JSON array of objects); keys have aliases, blanks are null."""
    rows = payloads.select("aggregate_id", F.col("variable_id").cast("string").alias("variable_id"), F.explode(F.from_json("payload", _PAYLOAD)).alias("r"))

    def first(*names: str) -> Column:
        return F.coalesce(*[F.nullif(F.try_element_at("r", F.lit(n)), F.lit("")) for n in names])

    dims = F.array(*[F.struct(F.lit(f"D{i}").alias("key"), F.struct(F.try_element_at("r", F.lit(f"D{i}C")).alias("code"), F.try_element_at("r", F.lit(f"D{i}N")).alias("name")).alias("value")) for i in range(1, 10)])
    told = F.filter(dims, lambda d: d["value"]["code"].isNotNull() | d["value"]["name"].isNotNull())
    raw = F.try_element_at("r", F.lit("V"))
    return rows.select(
        "aggregate_id", "variable_id", F.try_element_at("r", F.lit("D1N")).alias("variable_name"), first("NC", "MC").alias("locality_id"), first("NN", "MN").alias("locality_name"),
        first("D3C", "D2C", "P").alias("period_id"), first("D3N", "D2N", "PN").alias("period_name"), x.lenient_double(raw).alias("value"), raw.alias("raw_value"), F.map_from_entries(told).alias("dimensions"),
    )


def value_records(values: DataFrame) -> DataFrame:
    """Value rows as canonical records: a seven-character locality is a municipality, a missing value is excluded."""
    ym = t.year_month(F.col("period_id"))
    none = lambda kind: F.create_map().cast(kind)
    return values.select(
        F.struct(F.when(F.length("locality_id") == 7, F.col("locality_id")).alias("municipality"), ym["year"].alias("year"), ym["month"].alias("month"), F.lit(None).cast("date").alias("date")).alias("support"),
        F.lit("aggregate_context").alias("support_role"), F.lit("aggregate_context").alias("event_type"),
        F.struct(F.lit("SIDRA").alias("system"), F.col("aggregate_id").cast("string").alias("dataset"), F.lit(None).cast("string").alias("file")).alias("source"),
        none("map<string,array<string>>").alias("code_roles"), none("map<string,string>").alias("subgroups"), F.create_map(F.lit("value"), F.col("value")).alias("continuous"),
        none("map<string,array<string>>").alias("annotations"), F.lit(1.0).alias("weight"), F.struct(F.col("value").isNotNull().alias("included"), F.array().cast("array<string>").alias("flags")).alias("quality"),
        F.create_map(F.lit("aggregate_id"), F.col("aggregate_id").cast("string"), F.lit("variable_id"), F.col("variable_id")).alias("provenance"), F.to_json("dimensions").alias("dimensions"),
    )


def period_order(periods_: DataFrame) -> DataFrame:
    """Adds ``position`` of a table's periods: by ordinal, those without last, then by id."""
    own = Window.partitionBy("agregado_id").orderBy(F.coalesce("periodo_ord", F.lit(99999999)), "periodo_id")
    return periods_.withColumn("position", F.row_number().over(own))


def show(catalog: dict[str, DataFrame], table_id: int) -> dict[str, DataFrame]:
    """What there is about one table, by catalogue table."""
    return {name: df.where(F.col("id" if name == "agregados" else "agregado_id") == table_id) for name, df in catalog.items()}


#: Localities and periods of one request; localities that make a table nation-wide.
LOCALITIES, PERIODS = 25, 12
NATIONAL = 25 * 200


def request_shards(requests: DataFrame, localities: int = LOCALITIES, periods: int = PERIODS) -> DataFrame:
    """Each request (``aggregate_id, variable_id, localities, periods``) as the product of bounded pieces of its two lists; an empty list is one empty piece."""

    def pieces(c: str, n: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(c) / F.lit(n)).cast("int") - 1, F.lit(0)))
        return F.transform(starts, lambda i: F.slice(F.col(c), i * n + 1, n))

    by_place = requests.select("aggregate_id", "variable_id", "periods", F.posexplode(pieces("localities", localities)).alias("_l", "_localities"))
    both = by_place.select("aggregate_id", "variable_id", "_l", F.col("_localities").alias("localities"), F.posexplode(pieces("periods", periods)).alias("_p", "_periods"))
    return both.select("aggregate_id", "variable_id", F.col("_l").alias("locality_shard"), F.col("_p").alias("period_shard"), "localities", F.col("_periods").alias("periods"))


def national(levels: DataFrame, level: str = "N6", least: int = NATIONAL) -> DataFrame:
    """``agregado_id, localities, covers_national``: whether a table has so many localities of a level that it covers the nation."""
    n = F.coalesce(F.try_element_at("counts", F.lit(level)), F.lit(0)).cast("long")
    return level_counts(levels).select("agregado_id", n.alias("localities"), (n >= least).alias("covers_national"))


def candidates(tables: DataFrame, subject: str | None = None, survey: str | None = None) -> DataFrame:
    """The tables whose subject and survey contain the given texts, letters' marks and case aside."""
    out = tables
    for column, text in (("assunto", subject), ("pesquisa", survey)):
        if text:
            out = out.where(F.contains(x.normalize_basic(F.col(column)), x.normalize_basic(F.lit(text))))
    return out


def table_text(tables: DataFrame) -> DataFrame:
    """``agregado_id, text``: what names a table, a line each; blanks left out."""
    return tables.select(F.col("id").alias("agregado_id"), F.concat_ws("\n", *[F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in ("id", "nome", "pesquisa", "assunto", "freq")]).alias("text"))
