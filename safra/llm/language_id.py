"""Language identification as inference of a mixture of languages.

Model: for each language the smoothed log probability of hashed byte 4-grams within
words, from counts over every labelled training row (no sample). Inference: a text is a
bag of segments of ``SEGMENT`` words, each drawn from one language; expectation-
maximisation estimates the text's language proportions from the segments' n-gram
likelihoods. The language set starts with the likeliest language and grows, in order of
proportion, while the likelihood penalised by ``(k - 1) / 2 * log(segments) + (k - 1) * MARGIN`` improves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from .common import byte_slices, crc_mod, handing_back, read_table, text_sizes

BUCKETS = 1 << 16
SEGMENT = 4
MARGIN = 4.0
ROUNDS = 12
SMOOTH = 0.5
BATCH_BYTES = 1 << 20
#: What an inference adds to a row.
FOUND = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("languages", ArrayType(StringType())), StructField("proportions", ArrayType(DoubleType())), StructField("n_segments", LongType())]


def _grams(flat: np.ndarray) -> np.ndarray:
    """Hash of the four bytes that end at each position; the first three positions look before the text."""
    x = np.concatenate([np.full(3, 32, np.uint8), flat]).astype(np.uint32)
    h = x[3:] | x[2:-1] << np.uint32(8) | x[1:-2] << np.uint32(16) | x[:-3] << np.uint32(24)
    h *= np.uint32(2654435761)
    return h >> np.uint32(16)


def _prepare(texts: list[str | None]) -> list[bytes]:
    """Lower case, one space before and after; anything but letters reads as a space."""
    return [b" " + _not_letters(t.lower()).encode() + b" " if t else b" " for t in texts]


_RUNS = regex.compile(r"\P{L}+")


def _not_letters(text: str) -> str:
    return _RUNS.sub(" ", text)


class LanguageModel:
    """``languages`` in code-point order and ``table[bucket, language]`` of log probabilities."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        counts = counts.astype(np.float64) + SMOOTH
        self.table = np.log(counts / counts.sum(0)).astype(np.float32)

    def segments(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood of every segment by language, and the number of segments of each text."""
        sizes = np.array([len(t) for t in texts])
        flat = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(sizes)
        space = flat == 32
        # A gram ends in a word or at the space after it; a space after a space scores nothing.
        scored = ~space
        scored[1:] |= ~space[:-1]
        doc = np.repeat(np.arange(len(texts)), sizes)
        starts_word = ~space
        starts_word[1:] &= space[:-1]
        at = np.flatnonzero(starts_word)
        owner = doc[at]
        first_of_doc = np.searchsorted(owner, np.arange(len(texts)))
        rank = np.arange(len(at)) - first_of_doc[owner] if len(at) else np.zeros(0, np.int64)
        heads = at[rank % SEGMENT == 0]
        n = np.bincount(doc[heads], minlength=len(texts)) if len(heads) else np.zeros(len(texts), np.int64)
        if not len(heads):
            return np.zeros((0, len(self.languages))), n
        scores = self.table[_grams(flat)]
        scores[~scored] = 0
        del ends
        return np.add.reduceat(scores, heads, axis=0, dtype=np.float64), n

    def mixtures(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Proportions (texts x languages, zero outside the chosen set), set size, and segments; no rows of zeros but for texts without letters."""
        score, n = self.segments(texts)
        k_all = len(self.languages)
        out, size = np.zeros((len(texts), k_all)), np.zeros(len(texts), np.int64)
        live = np.flatnonzero(n)
        if not len(live) or not k_all:
            return out, size, n
        begin = np.concatenate([[0], np.cumsum(n[live])[:-1]])
        doc = np.repeat(np.arange(len(live)), n[live])
        top = score.max(1, keepdims=True)
        like = np.exp(score - top)
        base = np.add.reduceat(top[:, 0], begin)

        def fit(allowed: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """EM for some texts, over the languages allowed to each."""
            chosen = np.zeros(len(live), bool)
            chosen[docs] = True
            rows = chosen[doc]
            at = (np.cumsum(chosen) - 1)[doc[rows]]
            edge = np.concatenate([[0], np.cumsum(n[live][docs])[:-1]])
            p, own = like[rows], allowed / allowed.sum(1, keepdims=True)
            for _ in range(ROUNDS):
                joint = p * own[at]
                joint /= np.maximum(joint.sum(1, keepdims=True), 1e-300)
                own = np.add.reduceat(joint, edge, axis=0) / n[live][docs][:, None]
            total = np.log(np.maximum((p * own[at]).sum(1), 1e-300))
            return own, np.add.reduceat(total, edge) + base[docs]

        every = np.arange(len(live))
        full, _ = fit(np.ones((len(live), k_all)), every)
        alone = np.add.reduceat(score, begin, axis=0)
        best = alone.max(1)
        result = np.zeros((len(live), k_all))
        result[every, alone.argmax(1)] = 1
        k_best = np.ones(len(live), np.int64)
        order = np.argsort(-full, axis=1, kind="stable")
        for k in range(2, k_all + 1):
            # A set grows by one language as long as that gained in likelihood after the penalty.
            docs = np.flatnonzero((k_best == k - 1) & (n[live] >= k) & (np.take_along_axis(full, order[:, k - 1 : k], 1)[:, 0] > 0))
            if not len(docs):
                break
            allowed = np.zeros((len(docs), k_all))
            np.put_along_axis(allowed, order[docs, :k], 1.0, 1)
            own, total = fit(allowed, docs)
            total -= (k - 1) * (0.5 * np.log(n[live][docs]) + MARGIN)
            won = total > best[docs]
            best[docs[won]], k_best[docs[won]], result[docs[won]] = total[won], k, own[won]
        out[live], size[live] = result, k_best
        return out, size, n


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """From every row with a text and a language. The model has ``BUCKETS`` numbers a language, whatever the input."""

    @handing_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for a, b in byte_slices(text_sizes(batch.column(0)), BATCH_BYTES):
                texts = batch.column(0).slice(a, b - a).to_pylist()
                for lang in set(langs[a:b]):
                    flat = np.frombuffer(b"".join(_prepare([t for t, x in zip(texts, langs[a:b], strict=True) if x == lang])), np.uint8)
                    space = flat == 32
                    scored = ~space
                    scored[1:] |= ~space[:-1]
                    held[lang] = held.get(lang, 0) + np.bincount(_grams(flat)[scored], minlength=BUCKETS)
        for lang, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))], ["lang", "bucket", "n"])

    labelled = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    summed = labelled.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = summed.toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS, len(names)))
    code = {x: i for i, x in enumerate(names)}
    langs = np.array([code[x] for x in table.column("lang").to_pylist()], np.int64)
    counts[table.column("bucket").to_numpy(), langs] = table.column("n").to_numpy()
    return LanguageModel(names, counts)


def predict(docs: DataFrame, model: LanguageModel, columns: list[str], text_col: str = "text") -> DataFrame:
    """The given columns with ``lang_pred, score, languages, proportions, n_segments``.

    ``lang_pred`` is the language of largest proportion (the first in code-point order of
    equals), ``score`` its proportion. A null text, or one without a letter, is ``und``
    with score 0; so is every text when the model has no language. Repeated rows repeat, an
    empty table gives no rows, and columns not asked for are not read.
    """
    carried = docs.select(*[F.col(c) for c in columns], F.col(text_col).alias("_text"))
    out = StructType([*docs.select(*columns).schema.fields, *FOUND])
    return _inferred(carried, model, out, lambda batch: batch.column(batch.num_columns - 1), len(columns))


def _inferred(carried: DataFrame, model: LanguageModel, out: StructType, text_of: Callable[[pa.RecordBatch], pa.Array], n_kept: int) -> DataFrame:
    """The first ``n_kept`` columns and the inference from the text that ``text_of`` finds in a batch."""
    shared = carried.sparkSession.sparkContext.broadcast(model)

    @handing_back
    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            column = text_of(batch)
            for a, b in byte_slices(text_sizes(column), BATCH_BYTES):
                share, size, n = own.mixtures(_prepare(column.slice(a, b - a).to_pylist()))
                names, scores, sets, parts = [], [], [], []
                for row, k in zip(share, size.tolist(), strict=True):
                    if k == 0:
                        names.append("und"), scores.append(0.0), sets.append([]), parts.append([])
                        continue
                    top = np.argsort(-row, kind="stable")[:k].tolist() if k > 1 else [int(row.argmax())]
                    names.append(own.languages[top[0]])
                    scores.append(min(1.0, float(row[top[0]])))
                    sets.append([own.languages[i] for i in top])
                    parts.append([float(row[i]) for i in top])
                made = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string())), pa.array(parts, pa.list_(pa.float64())), pa.array(n, pa.int64())]
                kept = [batch.column(i).slice(a, b - a) for i in range(n_kept)]
                yield pa.RecordBatch.from_arrays(kept + made, out.names)

    return carried.mapInArrow(infer, out)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents``; the model learns from labelled rows that are not held out.

    A null id counts as the empty text in crc32; repeated rows repeat; without labelled rows all is ``und``.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = train(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return predict(rows, model, ["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score", "languages", "proportions", "n_segments")


def identified(docs: DataFrame, labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text is in some language, with their columns; a null ``lang_col`` takes the predicted language.

    Rows without a text or with no letter in it go. The model learns from ``labelled``; where that has no
    row with a language, every row with a letter stays as it is. Repeated rows repeat; an empty table stays empty.
    A row crosses to the worker once, as a whole, so its columns may have any names.
    """
    model = train(labelled, text_col, lang_col)
    if not model.languages:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    carried = docs.select(F.struct("*").alias("row"))
    found = _inferred(carried, model, StructType([*carried.schema.fields, *FOUND]), lambda batch: batch.column(0).field(text_col), 1)
    found = found.where(F.col("lang_pred") != "und")
    return found.select(*[F.coalesce(F.col("row")[c], F.col("lang_pred")).alias(c) if c == lang_col else F.col("row")[c].alias(c) for c in docs.columns])
