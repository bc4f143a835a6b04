"""Documents near series, names nearly alike, clusters, communities, ranked titles, hierarchies, versions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import paths
from ..operators import communities, docs, fuzzy, hierarchy, linkage, nearest, ranking
from ..operators.graph import cut, shared_folder
from ..operators.profile import jaccard_pairs
from ..sources.versions import VersionedTable
from ..streaming.changes import scan_changes as changes_of
from .common import MANIFEST_SQL, manifest, table
from .profile import _seasons

# Directories and names of documents, dealt out by page.
_DOC_DIRS = ["public/data/SYSA/DOCS", "public/data/SYSB", "public/manuais", "public/data/SYSA/FINAL/TAB/x", "outros/a/b", "public/data/SYSC/PRELIM"]
_DOC_NAMES = ["layout_promo", "nota", "manual-standard", "dados"]


def _page_docs(spark, d):
    """PDFs, one a page."""
    n = F.col("page_id")
    pick = lambda options: F.element_at(F.array(*[F.lit(o) for o in options]), (n % len(options) + 1).cast("int"))
    return table(spark, d, "pages").select(F.concat(F.lit("/"), pick(_DOC_DIRS), F.lit("/"), pick(_DOC_NAMES), F.lit("_"), n.cast("string"), F.lit(".pdf")).alias("url"))


def doc_distances(spark, d):
    """Documents four steps or fewer from a directory of files, with the steps."""
    dirs = manifest(spark, d).select(paths.directory(F.col("path")).alias("directory")).distinct()
    pages = cut(_page_docs(spark, d).withColumn("directory", paths.directory(F.col("url"))))
    near = docs.near_directories(dirs, pages)
    name = F.lower(paths.file_name(F.col("url")))
    return near.join(pages, near["b"] == pages["directory"]).select(F.col("a").alias("source_path"), "url", F.col("distance").cast("int").alias("distance"), docs.has_word(name).alias("reference"))


def doc_association(spark, d):
    stems = F.regexp_extract("path", r"/([A-Z]+?)[A-Z]{2}\d+\.[^/]*$", 1)
    series = manifest(spark, d).select(stems.alias("series"), paths.directory(F.col("path")).alias("source_path")).distinct()
    return docs.associate(series, _page_docs(spark, d))


def doc_tiers(spark, d):
    """Parts as documents of their brand, which stands for a system; types within a brand as families."""
    part = table(spark, d, "part").withColumns({"one": F.split_part("p_name", F.lit(" "), F.lit(1)), "two": F.split_part("p_name", F.lit(" "), F.lit(2))})
    kinds = part.groupBy("p_brand", "p_type").agg(F.min("one").alias("subsystem"), F.array(F.concat(F.lit("/a/"), F.min("two"))).alias("source_paths"))
    families = kinds.select(F.concat_ws(":", "p_brand", "p_type").alias("family_id"), F.col("p_brand").alias("system"), "subsystem", F.col("p_type").alias("prefix"), "source_paths")
    k = F.col("p_partkey")
    last = F.when(k % 4 == 0, "layout").when(k % 4 == 1, F.col("p_type")).when(k % 4 == 2, "x").otherwise("nota")
    told = part.select(F.concat(F.lit("part"), k.cast("string")).alias("url"), F.concat_ws("_", "one", "two", last).alias("filename"), F.lit("/d1/y").alias("directory"), F.col("p_brand").alias("system"), F.when(k % 7 == 0, F.col("one")).alias("subsystem"), F.when(k % 5 == 0, F.array(F.lit("manual"))).otherwise(F.array().cast("array<string>")).alias("keyword_hits"))
    return docs.associate_by_words(families, told)


def pdf_audit(spark, d):
    """The PDFs of pages below an endpoint; every third page's document belongs to a family."""
    n = F.col("page_id")
    pick = lambda options: F.element_at(F.array(*[F.lit(o) for o in options]), (n % len(options) + 1).cast("int"))
    root = F.when(n % 11 == 0, "/outros").otherwise("/dissemin/publicos")
    path = F.concat(root, pick(_AUDIT_DIRS), F.lit("/"), pick(_AUDIT_NAMES), n.cast("string"), F.when(n % 13 == 0, ".txt").otherwise(".pdf"))
    files = table(spark, d, "pages").select("page_id", path.alias("path")).withColumn("url", F.concat(F.lit("https://example.org"), "path"))
    return docs.pdf_audit(files, files.where("page_id % 3 = 0").select("url"), "/dissemin/publicos", 3, 200)


_AUDIT_DIRS = ["/SIM/DOCS", "/SIM/TABELAS/x", "/SINASC/DOCUMENTOS", "/SINASC/DADOS", "/CNES", ""]
_AUDIT_NAMES = ["manual_", "Layout_", "dados_", "nota_"]


def _names(spark, d):
    return table(spark, d, "part").select(F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("name"))


def name_edit_pairs(spark, d):
    return fuzzy.edit_pairs(_names(spark, d), "name", 1)


def name_likely_pairs(spark, d):
    return fuzzy.likely_pairs(_names(spark, d), "name").select("a", "b", F.round("score", 6).alias("score"))


def name_merge(spark, d):
    return fuzzy.fuzzy_merge(_names(spark, d), "name").withColumn("score", F.round("score", 6))


def schema_linkage(spark, d):
    """Nations in each season as schemas: the days and states of their orders, clustered down to a similarity of 0.2."""
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, d, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    item = F.concat_ws("/", F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.quarter("o_orderdate").cast("string"))
    fields = cut(orders.select(item.alias("item"), F.concat_ws("|", F.date_format("o_orderdate", "dd"), "o_orderstatus").alias("field")).distinct())
    pairs = jaccard_pairs(fields, "item", "field", 0.2)
    return linkage.complete_linkage(fields.select("item"), pairs.withColumn("similarity", F.round("similarity", 9)), 0.2)


def variable_communities(spark, d):
    """Communities of variables of a family that are alike in name and values."""
    from ..operators import profile as p

    pairs = cut(p.variable_pairs(*_seasons(spark, d)))
    return communities.communities(pairs.select(F.col("component").alias("graph"), "a", "b"))


def top_cosine_pairs(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", "embedding", "label")
    return nearest.top_pairs(v, "vec_id", "embedding", "label", 100).select("a", "b", F.round("cosine", 6).alias("cosine"))


def title_ranking(spark, d):
    """Titles of pages ranked for each passage of the benchmark."""
    titles = table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    found = ranking.best_matches(titles, table(spark, d, "benchmark"), "page_id", "title", "item_id", "text", 5)
    return found.select(F.col("query").alias("item_id"), F.col("doc").alias("page_id"), F.round("score", 6).alias("score"), "rank")


def _codes(spark, d):
    code = F.upper(F.regexp_replace("p_brand", "[^A-Za-z0-9]", ""))
    return table(spark, d, "part").select(F.concat(code, F.lit("X"), F.col("p_size").cast("string")).alias("code"), "p_retailprice")


def code_closure(spark, d):
    """Parts counted at every level of their code: brand, its beginnings, and size."""
    codes = _codes(spark, d)
    own = codes.groupBy(F.col("code").alias("node")).agg(F.count(F.lit(1)).alias("value"))
    return hierarchy.roll_up(own, hierarchy.by_prefix(codes, "code", [5, 6]))


def code_descent(spark, d):
    """The orders of a region shared down to nations and, within them, segments, by their customers."""
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, d, "nation")
    n, r = F.concat(F.lit("n"), F.col("n_nationkey").cast("string")), F.concat(F.lit("r"), F.col("n_regionkey").cast("string"))
    cells = cut(customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", n.alias("nation"), r.alias("region"), F.concat_ws("/", n, "c_mktsegment").alias("segment")))
    edges = cells.select(F.col("nation").alias("child"), F.col("region").alias("parent")).unionByName(cells.select(F.col("segment").alias("child"), F.col("nation").alias("parent"))).distinct()
    weights = cells.groupBy(F.col("nation").alias("node")).agg(F.count(F.lit(1)).alias("weight")).unionByName(cells.groupBy(F.col("segment").alias("node")).agg(F.count(F.lit(1)).alias("weight")))
    orders = table(spark, d, "orders").select("o_custkey")
    totals = orders.join(cells, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("region").alias("node")).agg(F.count(F.lit(1)).alias("value"))
    return hierarchy.descend(totals, edges, weights).withColumn("value", F.round("value", 9))


def versioned_upsert(spark, d):
    """Customers, then the balances of some of them and new ones: the pinned first version, and the latest."""
    held = VersionedTable(spark, f"{shared_folder(spark)}/versions-{uuid.uuid4().hex}")
    customer = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    first = held.write(customer.where("c_custkey % 4 != 0"))
    pinned = held.read(first)
    held.upsert(customer.where("c_custkey % 4 = 0 or c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1), ["c_custkey"])
    told = lambda df, name: df.agg(F.lit(name).alias("version"), F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))
    return told(pinned, "first").unionByName(told(held.read(), "latest"))


def scan_changes(spark, d):
    """Users of the first and of the second half of the events as two scans, an empty one between, arriving as a stream."""
    base = f"{shared_folder(spark)}/scans-{uuid.uuid4().hex}"
    users = cut(table(spark, d, "events").select("user_id", (F.dayofmonth("ts") > 15).alias("late")).distinct())
    last, changes = VersionedTable(spark, f"{base}/last"), VersionedTable(spark, f"{base}/changes")
    for part in ("not late", "false", "late"):
        users.where(part).select("user_id").coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("user_id long").parquet(f"{base}/in")
        changes_of(stream, "user_id", last, changes).option("checkpointLocation", f"{base}/log").trigger(availableNow=True).start().awaitTermination()
    return changes.read().groupBy("scan", "change").agg(F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users"))


QUERIES = {
    f.__name__: f
    for f in (
        doc_distances, doc_association, doc_tiers, pdf_audit, name_edit_pairs, name_likely_pairs, name_merge, schema_linkage, variable_communities, top_cosine_pairs, title_ranking, code_closure, code_descent,
        versioned_upsert, scan_changes,
    )
}

_list = lambda options: "[" + ",".join(f"'{o}'" for o in options) + "]"
_ALIKE = "SELECT DISTINCT p_name || ' ' || p_size AS n FROM part"
_CUTS = "[substr({0}, 1, i - 1) || substr({0}, i + 1) FOR i IN range(1, length({0}) + 1)]"
_TOKENS = "list_filter(regexp_split_to_array(upper({}), '[^A-Z0-9]+'), lambda w: length(w) >= 2)"
_TITLE = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
_HINTS = "['TAB','TABS','TABWIN','DICIONARIO','DIC','LAYOUT','MANUAL','ESTRUTURA','INFORME','NOTA','DOCS']"
SQL = {
    "doc_distances": f"""WITH {MANIFEST_SQL}, s AS (SELECT DISTINCT directory, list_filter(string_split(directory, '/'), lambda q: q <> '') AS a FROM manifest),
        p AS (SELECT '/' || {_list(_DOC_DIRS)}[page_id % {len(_DOC_DIRS)} + 1] || '/' || {_list(_DOC_NAMES)}[page_id % {len(_DOC_NAMES)} + 1] || '_' || page_id || '.pdf' AS url, string_split({_list(_DOC_DIRS)}[page_id % {len(_DOC_DIRS)} + 1], '/') AS b FROM pages),
        x AS (SELECT directory, url, len(a) + len(b) - 2 * len(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[1:i] = b[1:i])) AS distance FROM s, p)
        SELECT directory AS source_path, url, CAST(distance AS INTEGER) AS distance, regexp_matches(regexp_extract(url, '[^/]*$'), 'manual|dicionario|leia-me|layout|estrutura|dic_dados|instrucoes') AS reference FROM x WHERE distance <= 4""",
    "doc_tiers": f"""WITH q AS (SELECT *, split_part(p_name, ' ', 1) AS one, split_part(p_name, ' ', 2) AS two FROM part),
        f AS (SELECT p_brand || ':' || p_type AS family_id, p_brand AS system, upper(min(one)) AS sub, p_type AS prefix, list_distinct({_TOKENS.format('min(one)')} || [p_type] || {_TOKENS.format('min(two)')}) AS ws FROM q GROUP BY p_brand, p_type),
        e AS (SELECT 'part' || p_partkey AS url, p_brand AS system, CASE WHEN p_partkey % 7 = 0 THEN upper(one) ELSE '' END AS sub, one || '_' || two || '_' || CASE p_partkey % 4 WHEN 0 THEN 'layout' WHEN 1 THEN p_type WHEN 2 THEN 'x' ELSE 'nota' END AS filename, p_partkey % 5 = 0 AS hit FROM q),
        g AS (SELECT *, list_distinct({_TOKENS.format('filename')} || ['D1']) AS ws FROM e),
        m AS (SELECT family_id, url, filename, f.sub = g.sub AS s, list_contains(g.ws, prefix) AS p, len(list_intersect(f.ws, g.ws)) AS o, hit OR list_has_any(g.ws, {_HINTS}) AS generic FROM f JOIN g USING (system)),
        t AS (SELECT *, CASE WHEN s OR p OR o >= 2 THEN 'family_specific' WHEN generic THEN 'system_generic' END AS match_tier, CASE WHEN s OR p OR o >= 2 THEN 60 + CASE WHEN s THEN 20 ELSE 0 END + CASE WHEN p THEN 20 ELSE 0 END + least(o * 6, 18) ELSE 35 + least(o * 4, 12) END AS score FROM m),
        r AS (SELECT *, row_number() OVER (PARTITION BY family_id, match_tier ORDER BY score DESC, filename, url) AS rank FROM t WHERE match_tier IS NOT NULL)
        SELECT family_id, url, match_tier, CAST(score AS INTEGER) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= CASE match_tier WHEN 'family_specific' THEN 12 ELSE 6 END""",
    "pdf_audit": f"""WITH f AS (SELECT page_id, CASE WHEN page_id % 11 = 0 THEN '/outros' ELSE '/dissemin/publicos' END || {_list(_AUDIT_DIRS)}[page_id % {len(_AUDIT_DIRS)} + 1] AS dir, {_list(_AUDIT_NAMES)}[page_id % {len(_AUDIT_NAMES)} + 1] || page_id || CASE WHEN page_id % 13 = 0 THEN '.txt' ELSE '.pdf' END AS name FROM pages),
        p AS (SELECT *, 'https://example.org' || dir || '/' || name AS url, page_id % 3 <> 0 AS orphan, regexp_matches(lower(name), 'manual|dicionario|leia-me|layout|estrutura|dic_dados|instrucoes') OR contains(upper(dir), '/DOC') OR contains(upper(dir), '/DOCS') OR contains(upper(dir), '/DOCUMENTOS') OR contains(upper(dir), '/TAB') OR contains(upper(dir), '/TABELAS') AS ref,
          CASE WHEN dir = '/dissemin/publicos' THEN name ELSE string_split(dir, '/')[4] END AS top FROM f WHERE name LIKE '%.pdf' AND (dir || '/') LIKE '/dissemin/publicos/%'),
        c AS (SELECT 'count' AS section, unnest(['pdfs', 'matched', 'orphans', 'likely_reference_orphans']) AS item, unnest([count(*), count(*) FILTER (WHERE NOT orphan), count(*) FILTER (WHERE orphan), count(*) FILTER (WHERE orphan AND ref)]) AS n, NULL AS rank FROM p),
        k AS (SELECT 'top_level' AS section, top AS item, count(*) AS n, 50 AS most FROM p GROUP BY 2 UNION ALL SELECT 'directory', dir, count(*), 3 FROM p GROUP BY 2 UNION ALL SELECT 'orphan_directory', dir, count(*), 3 FROM p WHERE orphan GROUP BY 2
          UNION ALL SELECT 'orphan', url, NULL, 200 FROM p WHERE orphan UNION ALL SELECT 'likely_reference_orphan', url, NULL, 200 FROM p WHERE orphan AND ref),
        r AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY n DESC, item) AS rank FROM k)
        SELECT section, item, n, CAST(rank AS INTEGER) AS rank FROM c UNION ALL SELECT section, item, n, CAST(rank AS INTEGER) FROM r WHERE rank <= most""",
    "name_edit_pairs": f"WITH x AS ({_ALIKE}) SELECT l.n AS a, r.n AS b, CAST(levenshtein(l.n, r.n) AS INTEGER) AS edits FROM x l JOIN x r ON l.n < r.n AND levenshtein(l.n, r.n) <= 1",
    # Names have 15 letters at most, so two letters may go in all: from the longer one, or one from each.
    "name_likely_pairs": f"""WITH x AS ({_ALIKE}), y AS (SELECT n, length(n) AS k FROM x), z AS (SELECT l.n AS a, r.n AS b, l.k AS i, r.k AS j, levenshtein(l.n, r.n) AS e FROM y l JOIN y r ON l.n < r.n AND abs(l.k - r.k) <= 2 AND levenshtein(l.n, r.n) <= 2),
        g AS (SELECT *, CASE WHEN i <> j AND e = abs(i - j) THEN e WHEN i = j AND list_has_any({_CUTS.format('a')}, {_CUTS.format('b')}) THEN 2 END AS gone FROM z)
        SELECT a, b, round(100.0 * (i + j - gone) / (i + j), 6) AS score FROM g WHERE gone IS NOT NULL AND 100.0 * (i + j - gone) / (i + j) >= 90""",
    "top_cosine_pairs": """WITH x AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS c FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND a.label <> b.label)
        SELECT a, b, round(c, 6) AS cosine FROM x ORDER BY c DESC, a, b LIMIT 100""",
    "title_ranking": f"""WITH t AS (SELECT page_id, {_TITLE.format("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS ws FROM pages), g AS (SELECT count(*) AS docs, avg(len(ws)) AS mean FROM t),
        p AS (SELECT page_id, word, len AS n, count(*) AS tf FROM (SELECT page_id, len(ws) AS len, unnest(ws) AS word FROM t) GROUP BY 1, 2, 3), d AS (SELECT word, count(*) AS df FROM p GROUP BY 1),
        q AS (SELECT DISTINCT item_id, unnest({_TITLE.format('text')}) AS word FROM benchmark),
        s AS (SELECT item_id, page_id, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean))), 9) AS score FROM q JOIN p USING (word) JOIN d USING (word), g GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, page_id) AS rank FROM s) SELECT item_id, page_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""",
    "code_closure": """WITH c AS (SELECT upper(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) || 'X' || p_size AS code FROM part), u AS (SELECT code, unnest(list_distinct([left(code, 5), left(code, 6), code])) AS node FROM c)
        SELECT node, count(*) FILTER (WHERE node = code) AS own, count(*) AS value FROM u GROUP BY 1""",
    "code_descent": """WITH c AS (SELECT c_custkey, 'n' || n_nationkey AS n, 'r' || n_regionkey AS r, 'n' || n_nationkey || '/' || c_mktsegment AS s FROM customer JOIN nation ON c_nationkey = n_nationkey),
        t AS (SELECT r, CAST(count(*) AS DOUBLE) AS v FROM orders JOIN c ON o_custkey = c_custkey GROUP BY 1), k AS (SELECT r, count(*) AS k FROM c GROUP BY 1)
        SELECT r AS node, round(v, 9) AS value, false AS leaf FROM t UNION ALL SELECT n, round(v * count(*) / k, 9), false FROM c JOIN t USING (r) JOIN k USING (r) GROUP BY n, v, k UNION ALL SELECT s, round(v * count(*) / k, 9), true FROM c JOIN t USING (r) JOIN k USING (r) GROUP BY s, v, k""",
    "versioned_upsert": """SELECT 'first' AS version, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer WHERE c_custkey % 4 <> 0
        UNION ALL SELECT 'latest', count(*), round(sum(c_acctbal + CASE WHEN c_custkey % 4 = 0 OR c_custkey % 3 = 0 THEN 1 ELSE 0 END), 2) FROM customer""",
    "scan_changes": """WITH a AS (SELECT DISTINCT user_id AS u FROM events WHERE day(ts) <= 15), b AS (SELECT DISTINCT user_id AS u FROM events WHERE day(ts) > 15)
        SELECT CAST(0 AS BIGINT) AS scan, 'added' AS change, count(*) AS n, CAST(sum(u) AS BIGINT) AS users FROM a UNION ALL SELECT 1, 'warning', 1, NULL
        UNION ALL SELECT 2, CASE WHEN a.u IS NULL THEN 'added' WHEN b.u IS NULL THEN 'removed' ELSE 'common' END, count(*), CAST(sum(coalesce(a.u, b.u)) AS BIGINT) FROM a FULL JOIN b ON a.u = b.u GROUP BY 2""",
}

