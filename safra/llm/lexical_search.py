"""Ranked lexical search by three phases of uniform thresholds over term-partitioned postings.

Documents are read once. Every task writes blocks of ``BLOCK`` documents: for each term that
some query uses, the places in the block that hold it, how often, and those documents'
lengths. The lists of a term are then dealt out by term (a frequent term over ``PIECES``
pieces) and written with each entry's exact contribution, best first. For k results a query:

1. the k best entries of every list give partial sums; the k-th best sum of a query is a
   lower bound ``low`` of its k-th score;
2. a query's threshold is one number T for all its lists, with the sum of min(T, best entry)
   over the lists no more than ``low``: a document below T everywhere can't reach ``low``.
   Every list sends its entries of T or more to their blocks, where they are summed; the
   k-th best of these sums is a higher bound, and with T for each list that sent nothing
   of a document, few documents can still reach it;
3. these candidates' entries are looked up in all lists of their query, which gives exact
   scores.

No document is lost in any phase, so the result is exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import binary_text, handing_back, materialize, read_table

K = 10
#: Documents of a block.
BLOCK = 1024
#: Parts over which the blocks of a term's list are dealt.
PIECES = 8
#: (query, term) pairs that are searched together, about; they are held by the driver and every worker.
PAIRS = 1 << 17
#: Queries whose sums over a block are held at once.
TOGETHER = 256

# Letters of a term: ASCII digits and letters, upper case folded, and every byte above ASCII.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def weight(documents: int, holding: int) -> int:
    """Of a term that so many of the documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def contributions(w: int, tf: np.ndarray, n: np.ndarray, documents: int, words: int) -> np.ndarray:
    """What a term of weight ``w`` adds to the scores of documents of ``n`` terms that hold it ``tf`` times."""
    tf = tf.astype(np.int64)
    m = 10 + (90 * n.astype(np.int64) * documents) // words
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def threshold(low: int, best: list[int]) -> int:
    """The largest whole T whose sum of min(T, best) is ``low`` at most."""
    left = low
    for i, x in enumerate(sorted(best)):
        if left <= x * (len(best) - i):
            return left // (len(best) - i)
        left -= x
    return max(best, default=0)


@handing_back
def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(set(terms_of(t.as_py()))) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])


_LISTS = "block long, term int, size int, places binary, tf binary, n binary, ids array<long>, words long"


def _posting(numbers: dict[bytes, int], block_rows: int):
    """For ``mapInArrow`` over (id, text): the lists of each block, and a row of its ids and lengths (term -1)."""
    names = ["block", "term", "size", "places", "tf", "n", "ids", "words"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64()]

    def block_rows_of(number: int, ids: list[int | None], lengths: list[int], lists: dict[int, list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
        sizes = np.array(lengths, "<i4")
        rows = [(number, -1, sum(x > 0 for x in lengths), None, None, None, ids, sum(lengths))]
        for term, entries in lists.items():
            e = np.array(entries, "<i4")
            rows.append((number, term, len(e), e[:, 0].tobytes(), e[:, 1].tobytes(), sizes[e[:, 0]].tobytes(), None, None))
        for i in range(0, len(rows), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i : i + 4096], strict=True), kinds, strict=True)], names)

    @handing_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        ids, lengths, lists = [], [], {}
        wanted = numbers.keys()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms_of(text.as_py())
                counts = Counter(words)
                for term in counts.keys() & wanted:
                    lists.setdefault(numbers[term], []).append((len(ids), counts[term]))
                ids.append(doc), lengths.append(len(words))
                if len(ids) == block_rows:
                    yield from block_rows_of(number, ids, lengths, lists)
                    number, ids, lengths, lists = number + 1, [], [], {}
        if ids:
            yield from block_rows_of(number, ids, lengths, lists)

    return run


def _scoring(weights: dict[int, int], documents: int, words: int):
    """For ``mapInArrow`` over lists: each with the contributions of its entries, best first."""

    @handing_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, scores = [], []
            for term, *parts in zip(batch["term"].to_pylist(), batch["places"].to_pylist(), batch["tf"].to_pylist(), batch["n"].to_pylist(), strict=True):
                at, tf, n = (np.frombuffer(x, "<i4") for x in parts)
                score = contributions(weights[term], tf, n, documents, words)
                order = np.argsort(-score, kind="stable")
                places.append(at[order].tobytes()), scores.append(score[order].tobytes())
            yield pa.RecordBatch.from_arrays([batch["block"], batch["term"], pa.array(places, pa.binary()), pa.array(scores, pa.binary())], ["block", "term", "places", "scores"])

    return run


_SCORED = "block long, term int, places binary, scores binary"


def _heads(k: int):
    """For ``mapInArrow`` over scored lists: a task's best k entries of each term."""

    @handing_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, term, places, scores in zip(*(batch[c].to_pylist() for c in ("block", "term", "places", "scores")), strict=True):
                at, score = np.frombuffer(places, "<i4")[:k], np.frombuffer(scores, "<i8")[:k]
                own = np.full(len(at), block), at, score
                if term in best:
                    own = tuple(map(np.concatenate, zip(best[term], own, strict=True)))
                    first = np.argsort(-own[2], kind="stable")[:k]
                    own = tuple(x[first] for x in own)
                best[term] = own
        for term, (block, at, score) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), term, np.int32)), pa.array(block), pa.array(at), pa.array(score)], ["term", "block", "place", "score"])

    return run


def _sending(least: dict[int, int]):
    """For ``mapInArrow`` over scored lists: the entries that some query's threshold asks for."""

    @handing_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block, term, places, scores in zip(*(batch[c].to_pylist() for c in ("block", "term", "places", "scores")), strict=True):
                if term in least:
                    n = _down_to(np.frombuffer(scores, "<i8"), least[term])
                    if n:
                        rows.append((block, term, places[: 4 * n], scores[: 8 * n]))
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["block", "term", "places", "scores"])

    return run


def _down_to(scores: np.ndarray, least: int) -> int:
    """How many of the scores, best first, are ``least`` or more."""
    return int(np.searchsorted(-scores, -least, side="right"))


def _summing(queries: list[list[tuple[int, int, int]]], lows: list[int], k: int, block_rows: int):
    """For ``applyInArrow`` over a block's entries: the documents that can still be among a query's k best.

    ``queries`` has for each query its (term, threshold, most that the list can hold back).
    A document's sum with all that its silent lists can hold back must reach the block's own
    k-th best sum, which is no more than that of all blocks.
    """

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        lists = {t: (np.frombuffer(p, "<i4"), np.frombuffer(s, "<i8")) for t, p, s in zip(*(table[c].to_pylist() for c in ("term", "places", "scores")), strict=True)}
        out = []
        total, back = np.empty(block_rows, np.int64), np.empty(block_rows, np.int64)
        for q, parts in enumerate(queries):
            total[:], back[:], all_back = 0, 0, 0
            for term, least, held in parts:
                all_back += held
                if term in lists:
                    at, score = lists[term]
                    n = _down_to(score, least)
                    total[at[:n]] += score[:n]
                    back[at[:n]] += held
            top = np.partition(total, block_rows - min(k, block_rows))[block_rows - min(k, block_rows)]
            at = np.flatnonzero((total > 0) & (total - back + all_back >= max(lows[q], int(top))))
            if len(at):
                out.append((np.full(len(at), q, np.int32), at.astype(np.int32), total[at], total[at] - back[at] + all_back))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, t) for t in (np.int32, np.int32, np.int64, np.int64)]
        return pa.Table.from_arrays([pa.array(np.full(len(columns[0]), block, np.int64)), *map(pa.array, columns)], ["block", "query", "place", "partial", "most"])

    return run


def _looking_up(queries: list[list[int]], block_rows: int):
    """For ``applyInArrow`` over a block's candidates and its lists: exact scores."""

    def run(candidates: pa.Table, lists: pa.Table) -> pa.Table:
        asked = candidates["query"].to_numpy()
        at = candidates["place"].to_numpy()
        wanted = {t for q in np.unique(asked).tolist() for t in queries[q]}
        ids, dense = [], {}
        for term, places, scores, own in zip(*(lists[c].to_pylist() for c in ("term", "places", "scores", "ids")), strict=True):
            if own is not None:
                ids = own
            elif term in wanted and len(at):
                dense[term] = np.zeros(block_rows, np.int64)
                dense[term][np.frombuffer(places, "<i4")] = np.frombuffer(scores, "<i8")
        exact = np.zeros(len(at), np.int64)
        for q in np.unique(asked).tolist():
            rows = np.flatnonzero(asked == q)
            for term in queries[q]:
                if term in dense:
                    exact[rows] += dense[term][at[rows]]
        return pa.table({"query": pa.array(asked, pa.int32()), "doc_id": pa.array([ids[i] for i in at.tolist()], pa.int64()), "score": pa.array(exact, pa.int64())})

    return run


def _kth(rows: DataFrame, value: str, k: int) -> dict[int, int]:
    """The k-th largest value of each query that has so many."""
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.col(value).desc()))
    return {r.query: r[value] for r in rows.withColumn("_nth", nth).where(F.col("_nth") <= k).where(F.col("_nth") == k).select("query", value).collect()}


def _search_batch(docs: DataFrame, items: list, k: int, block_rows: int, pieces: int) -> DataFrame:
    """``query, doc_id, rank, score`` of some queries, numbered by their place in ``items``."""
    spark = docs.sparkSession
    numbers = {t: i for i, t in enumerate(sorted({t for x in items for t in x.terms}))}
    raw = materialize(docs.mapInArrow(_posting(numbers, block_rows), _LISTS), "postings")
    held = {r.term: (r.size, r.words) for r in raw.groupBy("term").agg(F.sum("size").alias("size"), F.sum("words").alias("words")).collect()}
    documents, words = held.pop(-1, (0, 0))
    weights = {t: weight(documents, df) for t, (df, _) in held.items()}
    lists = raw.where("term >= 0").repartition("term", F.pmod("block", F.lit(pieces)))
    scored = materialize(lists.mapInArrow(_scoring(weights, documents, words or 1), _SCORED), "scored")

    # First: the heads of all lists.
    queries = [[numbers[t] for t in x.terms if numbers[t] in held] for x in items]
    pairs = spark.createDataFrame(pa.table({"query": pa.array([q for q, x in enumerate(queries) for _ in x], pa.int32()), "term": pa.array([t for x in queries for t in x], pa.int32())}))
    nth = F.row_number().over(Window.partitionBy("term").orderBy(F.desc("score"), "block", "place"))
    heads = materialize(scored.mapInArrow(_heads(k), "term int, block long, place int, score long").withColumn("nth", nth).where(F.col("nth") <= k), "heads")
    best = {r.term: r.score for r in heads.where("nth = 1").select("term", "score").collect()}
    sums = heads.join(pairs, "term").groupBy("query", "block", "place").agg(F.sum("score").alias("score"))
    lows = _kth(sums, "score", k)

    # Second: one threshold a query for all its lists.
    low = [lows.get(q, 0) for q in range(len(items))]
    level = [threshold(low[q], [best[t] for t in x]) for q, x in enumerate(queries)]
    asked = [[(t, level[q], min(level[q], best[t])) for t in x] for q, x in enumerate(queries)]
    least: dict[int, int] = {}
    for parts in asked:
        for t, at_least, _ in parts:
            if best[t] >= at_least:
                least[t] = min(at_least, least.get(t, at_least))
    sent = scored.mapInArrow(_sending(least), _SCORED)
    summed = sent.groupBy("block").applyInArrow(_summing(asked, low, k, block_rows), "block long, query int, place int, partial long, most long")
    summed = materialize(summed, "summed")
    higher = _kth(summed, "partial", k)
    bound = spark.createDataFrame(pa.table({"query": pa.array(range(len(items)), pa.int32()), "bound": pa.array([max(low[q], higher.get(q, 0)) for q in range(len(items))], pa.int64())}))
    candidates = summed.join(bound, "query").where("most >= bound").select("block", "query", "place")

    # Third: the candidates' exact scores, from all lists.
    every = scored.select("block", "term", "places", "scores", F.lit(None).cast("array<long>").alias("ids"))
    every = every.unionByName(raw.where("term < 0").select("block", "term", F.lit(None).cast("binary").alias("places"), F.lit(None).cast("binary").alias("scores"), "ids"))
    exact = candidates.groupBy("block").cogroup(every.groupBy("block")).applyInArrow(_looking_up(queries, block_rows), "query int, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return exact.where("score > 0").withColumn("rank", rank).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_rows: int = BLOCK, pieces: int = PIECES, pairs: int = PAIRS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 for each item.

    Null texts have no terms; an item without terms, or without a document that holds one
    of them at a weight above 0, has no rows. Equal scores rank by ascending doc_id, null
    last. Every row of ``docs`` is a document of its own and every row of ``items`` an item,
    ids repeated or not. No documents or no items give no rows; other columns are ignored.

    Items are taken in batches of about ``pairs`` terms, drawn by a hash; the documents are
    read once a batch. A batch's terms, thresholds and bounds are all that reaches the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), binary_text(F.col(text_col)).alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), binary_text(F.col(item_text_col)).alias("text"))
    asked = materialize(asked.mapInArrow(_query_terms, "item_id long, terms array<binary>"), "queries")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    batches = max(1, -(-total // pairs))
    schema = "item_id long, rank int, doc_id long, score long"
    out = None
    for b in range(batches):
        mine = asked.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(batches)) == b).where(F.size("terms") > 0).collect()
        if not mine:
            continue
        names = spark.createDataFrame(pa.table({"query": pa.array(range(len(mine)), pa.int32()), "item_id": pa.array([r.item_id for r in mine], pa.int64())}))
        found = _search_batch(rows, mine, k, block_rows, pieces).join(names, "query").select("item_id", "rank", "doc_id", "score")
        found = found if batches == 1 else materialize(found, "found")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark
), g AS (SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS n_words FROM d WHERE len(ws) > 0
), m AS (SELECT doc_id, 10 + (90 * len(ws) * n_docs) // n_words AS m FROM d, g WHERE len(ws) > 0
), tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t
), w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), g
), s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN w USING (t) JOIN tf USING (t) JOIN m USING (doc_id) GROUP BY item_id, doc_id
), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
