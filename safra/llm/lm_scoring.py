"""Language-model scoring by a hashed maximum-entropy model with class-factored softmax.

Every word has a path of ``levels`` digits below ``BRANCH`` in a tree of classes:
P(word | history) is the product, over the path, of P(digit | digits so far, history), each a
softmax over the sum of hashed feature rows of the history: the previous word, the
previous two, and two skips (the word before the previous one, and the one before
that), each crossed with the digits so far, at every level. Twelve sixteenths of the leaves hold one frequent
word each; each other leaf holds the words of some endings, weighted by their
smoothed counts. The depth of the tree grows with the number of distinct words, to ``MOST_LEVELS``, so a leaf
holds about as many words at any size up to there; the hashed tables of feature rows grow with the training tokens,
from ``ROWS`` to ``MOST_ROWS`` rows. What a task holds of the model is so bounded, whatever the corpus.

Weights are trained by rounds of distributed gradient updates: every task descends over its
rows from the round's weights, and the tasks' changes, weighted by how often each row of
weights was updated, are averaged in the order of the tasks, so reruns over the same files agree.

Counts are of all training rows. The ``KNOWN`` most frequent words (a bounded table) are
broadcast; the counts of all others come by a shuffled join, so the vocabulary may be
of any size.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_text, crc_mod, handing_back, materialize, read_table, text_sizes

END = b"\n"  # no word holds a line break
KNOWN = 1 << 17
KNOWN_BYTES = 64
BRANCH = 16
#: Of the ``BRANCH`` top classes, those whose leaves hold one word each.
OWN = 12
#: Bytes of a word that choose its leaf, if it has none of its own.
ENDING = 3
#: The tree deepens until a leaf stands for as many distinct words at most.
LEAF_WORDS = 256
#: Depth of the tree at most: 16**5 leaves, 8 MB of masses.
MOST_LEVELS = 5
#: Features of every level: the previous word, the previous two, two skips.
FEATURES = 4
#: Rows of each table of weights, one table a level and feature: at least, and at most (84 MB of weights at the greatest depth).
ROWS = 1 << 14
MOST_ROWS = 1 << 16
#: Training tokens a row from which tables double with every fourfold of the tokens.
ROW_TOKENS = 1 << 12
BLOCK = 256
ROUNDS = 2
RATE = 0.2
#: Tokens scored at once, and tokens whose gradients are summed for one step.
BATCH = 1 << 15
STEP = 1 << 16
CHUNK = 1 << 16
DISTINCT = 200_000
_MULT = np.uint32(2654435761)


def words_of(text: bytes) -> list[bytes]:
    """Lower-case A-Z, then runs of bytes other than space and 0x09-0x0D."""
    return text.lower().split()


def count_tokens(rows: DataFrame) -> DataFrame:
    """``token, n`` over a binary column ``text``: words, and one end a row."""

    @handing_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for _, _, texts in _chunks(batch.column(0)):
                for text in texts:
                    held.update(words_of(text))
                held[END] += len(texts)
                if len(held) > DISTINCT:
                    yield _counted(held)
                    held = Counter()
        if held:
            yield _counted(held)

    return rows.select("text").mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["token", "n"])


def table_of(level: int, feature: int) -> int:
    """Number of a level's and feature's table of weights; of feature 0 of the level below the last, how many there are."""
    return level * FEATURES + feature


def levels_for(distinct: int) -> int:
    """Depth of the class tree for so many distinct words: 3 at least, ``MOST_LEVELS`` at most."""
    levels = 3
    while levels < MOST_LEVELS and BRANCH**levels * LEAF_WORDS < distinct:
        levels += 1
    return levels


def rows_for(tokens: int) -> int:
    """Rows of a table of weights for so many training tokens: they grow with the root of the tokens, between ``ROWS`` and ``MOST_ROWS``."""
    rows, reach = ROWS, 4 * ROWS * ROW_TOKENS
    while rows < MOST_ROWS and reach <= tokens:
        rows, reach = 2 * rows, 4 * reach
    return rows


class Vocabulary:
    """The most frequent words with their counts and leaves; the words and types of every shared leaf."""

    def __init__(self, tokens: list[bytes], counts: list[int], levels: int, shared_words: np.ndarray, shared_types: np.ndarray):
        if END in tokens:  # the end has a leaf of its own, however rare
            at = tokens.index(END)
            tokens.insert(0, tokens.pop(at)), counts.insert(0, counts.pop(at))
        self.levels = levels
        self.total, self.distinct = int(shared_words.sum()), int(shared_types.sum())
        self.ids = {t: i for i, t in enumerate(tokens)}
        n = np.array([*counts, 0], np.float64)
        self.log_count = np.log10(n + 0.5)
        self.key = np.array([crc32(t) for t in tokens] + [0], np.uint32)
        each = BRANCH ** (levels - 1)
        self.first_shared, self.n_shared = OWN * each, (BRANCH - OWN) * each
        own = min(len(tokens), self.first_shared)
        rank = np.arange(own)
        leaf, rest = rank % OWN, rank // OWN  # digits lowest first, so that frequent words are spread over all classes
        for _ in range(levels - 1):
            leaf, rest = leaf * BRANCH + rest % BRANCH, rest // BRANCH
        self.leaf = np.array([*leaf.tolist(), *(self.shared_leaf(t) for t in tokens[own:]), 0], np.int64)
        # Shared leaves hold what has no leaf of its own: the given figures are of all words.
        words, types = shared_words.astype(np.float64), shared_types.astype(np.float64)
        at = np.array([self.shared_leaf(t) for t in tokens[:own]], np.int64) - self.first_shared
        np.subtract.at(words, at, n[:own])
        np.subtract.at(types, at, 1)
        mass = np.zeros(BRANCH**levels)
        mass[leaf] = n[:own] + 0.5
        mass[self.first_shared :] = words + 0.5 * (types + 1)
        self.log_shared = np.log10(mass[self.first_shared :])
        #: Logits of each level without features, nodes x BRANCH; a leaf without a word has none.
        self.bias = []
        for level in range(levels):
            split = mass.reshape(BRANCH**level, BRANCH, -1).sum(2)
            with np.errstate(divide="ignore", invalid="ignore"):
                self.bias.append(np.log(split / split.sum(1, keepdims=True)).astype(np.float32))

    def shared_leaf(self, token: bytes) -> int:
        return self.first_shared + crc32(token[-ENDING:]) % self.n_shared

    def encode(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, their numbers (-1: unlisted), hash keys and leaves, and the token count of each text."""
        tokens: list[bytes] = []
        sizes = []
        for text in texts:
            own = words_of(text)
            tokens += own
            tokens.append(END)
            sizes.append(len(own) + 1)
        ids = np.fromiter(map(self.ids.get, tokens, repeat(-1)), np.int64, len(tokens))
        key, leaf = self.key[ids], self.leaf[ids]
        rare = np.flatnonzero(ids < 0)
        own = [tokens[i] for i in rare.tolist()]
        key[rare] = np.fromiter(map(crc32, own), np.uint32, len(own))
        leaf[rare] = np.fromiter(map(self.shared_leaf, own), np.int64, len(own))
        return tokens, ids, key, leaf, np.array(sizes)


def _histories(key: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """A hash of each token's history for each feature; words before the text are key 1."""
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.arange(len(key)) - start
    back = []
    for d in (1, 2, 3):
        x = np.concatenate([np.ones(min(d, len(key)), np.uint32), key[:-d]])
        back.append(np.where(at >= d, x, np.uint32(1)))
    return [back[0] * _MULT, (back[0] * np.uint32(40503) ^ back[1] * np.uint32(2246822519)) * _MULT, (back[1] ^ np.uint32(0x5BD1E995)) * _MULT, (back[2] ^ np.uint32(0x1B873593)) * _MULT]


def _rows(history: np.ndarray, node: np.ndarray, size: int) -> np.ndarray:
    """Row of weights, of ``size`` (a power of two), of a history crossed with a node of the tree."""
    m = history ^ node.astype(np.uint32) * np.uint32(374761393)
    m ^= m >> np.uint32(15)
    m *= np.uint32(3266489917)
    return (m >> np.uint32(33 - size.bit_length())).astype(np.intp)


def _path(leaf: np.ndarray, level: int, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of a level that the leaves lie below, and the digits that lead on."""
    below = BRANCH ** (levels - level - 1)
    return leaf // (below * BRANCH), leaf // below % BRANCH


class Model:
    """One table of weights a level and feature, rows x BRANCH each."""

    def __init__(self, levels: int, weights: np.ndarray | None = None, rows: int = ROWS):
        self.levels = levels
        self.weights = np.zeros((table_of(levels, 0), rows, BRANCH), np.float32) if weights is None else weights

    def log10(self, vocabulary: Vocabulary, key: np.ndarray, leaf: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """log10 P of every token, without the smoothed count of a word of a shared leaf."""
        histories, size = _histories(key, sizes), self.weights.shape[1]
        out = np.zeros(len(key))
        for a in range(0, len(key), BATCH):
            part = slice(a, a + BATCH)
            for level in range(self.levels):
                node, digit = _path(leaf[part], level, self.levels)
                z = vocabulary.bias[level].take(node, axis=0)
                for f, history in enumerate(histories):
                    z += self.weights[table_of(level, f)].take(_rows(history[part], node, size), axis=0)
                z = np.ascontiguousarray(z.T)
                top = z.max(0)
                out[part] += z[digit, np.arange(len(digit))] - top
                z -= top
                out[part] -= np.log(np.exp(z, out=z).sum(0))
        out /= math.log(10)
        shared = leaf >= vocabulary.first_shared
        out[shared] -= vocabulary.log_shared[leaf[shared] - vocabulary.first_shared]
        return out


class Learner:
    """A model under training. Its tables lie digit by digit (BRANCH x rows): the sums of gradients come so, and a digit's row fits the cache."""

    def __init__(self, model: Model, vocabulary: Vocabulary):
        self.vocabulary, self.levels = vocabulary, model.levels
        self.tables = np.ascontiguousarray(model.weights.transpose(0, 2, 1))
        self.bias = [np.ascontiguousarray(b.T) for b in vocabulary.bias]
        self.size = model.weights.shape[1]
        #: How often each row of weights was updated.
        self.seen = np.zeros((len(self.tables), self.size), np.float32)

    def _errors(self, level: int, histories: list[np.ndarray], leaf: np.ndarray, out: np.ndarray) -> list[np.ndarray]:
        """Writes probabilities less what came (BRANCH x tokens) to ``out``; the rows used, a feature each."""
        node, digit = _path(leaf, level, self.levels)
        rows = [_rows(h, node, self.size) for h in histories]
        z, drawn = np.empty((BRANCH, len(leaf)), np.float32), np.empty(len(leaf), np.float32)
        for b in range(BRANCH):
            np.take(self.bias[level][b], node, out=z[b], mode="clip")
            for f, row in enumerate(rows):
                np.take(self.tables[table_of(level, f), b], row, out=drawn, mode="clip")
                z[b] += drawn
        z -= z.max(0)
        np.exp(z, out=z)
        z *= 1 / z.sum(0)
        z[digit, np.arange(len(digit))] -= 1
        out[:] = z
        return rows

    def learn(self, key: np.ndarray, leaf: np.ndarray, sizes: np.ndarray, rate: float) -> None:
        """Descend in equal steps of about ``STEP`` tokens: the gradients of a row's uses are summed, and its steps shrink with the root of all its uses."""
        histories = _histories(key, sizes)
        bounds = np.linspace(0, len(key), max(1, round(len(key) / STEP)) + 1).astype(int).tolist()
        for start, end in zip(bounds, bounds[1:], strict=False):
            errors = np.empty((BRANCH, end - start))
            for level in range(self.levels):
                parts = [self._errors(level, [h[a : min(a + BATCH, end)] for h in histories], leaf[a : min(a + BATCH, end)], errors[:, a - start : a - start + BATCH]) for a in range(start, end, BATCH)]
                for f, pieces in enumerate(zip(*parts, strict=True)):
                    t, row = table_of(level, f), np.concatenate(pieces)
                    self.seen[t] += np.bincount(row, minlength=self.size)
                    step = rate / np.sqrt(np.maximum(self.seen[t], 1))
                    for b in range(BRANCH):
                        self.tables[t, b] -= np.bincount(row, errors[b], self.size) * step


def _chunks(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """Runs of texts of about ``CHUNK`` words (six bytes a word), one text at least."""
    sizes = text_sizes(column).tolist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > 6 * CHUNK:
            yield start, i, column.slice(start, i - start).to_pylist()
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes), column.slice(start).to_pylist()


def train(rows: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS, rate: float = RATE) -> Model:
    """Rounds of gradient updates over the rows' texts; a row (``text``, ``part`` 0 to rounds - 1) has its turn in one round."""
    spark = rows.sparkSession
    words = spark.sparkContext.broadcast(vocabulary)
    levels = vocabulary.levels
    model = Model(levels, rows=rows_for(vocabulary.total))
    size = model.weights.shape[1]
    per_table = size // BLOCK
    for turn in range(rounds):
        begun = spark.sparkContext.broadcast(model.weights)

        @handing_back
        def descend(batches: Iterator[pa.RecordBatch], begun=begun) -> Iterator[pa.RecordBatch]:
            own = Learner(Model(levels, begun.value), words.value)
            for batch in batches:
                for _, _, texts in _chunks(batch.column(0)):
                    _, _, key, leaf, sizes = words.value.encode(texts)
                    own.learn(key, leaf, sizes, rate)
            context = TaskContext.get()
            task = context.partitionId() if context else 0
            seen = own.seen
            for t in range(len(seen)):
                change = (own.tables[t].T - begun.value[t]) * seen[t][:, None]
                for k in range(per_table):
                    at = slice(k * BLOCK, (k + 1) * BLOCK)
                    if seen[t, at].any():
                        scale = max(1.0, float(np.abs(change[at]).max()) / 1000)
                        values = [t * per_table + k, task, scale, seen[t, at].tobytes(), (change[at] / scale).astype(np.float16).tobytes()]
                        yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, (pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary()), strict=True)], ["block", "task", "scale", "seen", "change"])

        @handing_back
        def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, n, total = None, np.zeros(BLOCK), np.zeros((BLOCK, BRANCH))

            def mean() -> pa.RecordBatch:
                value = (total / np.maximum(n, 1)[:, None]).astype(np.float32)
                return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([value.tobytes()], pa.binary())], ["block", "mean"])

            for batch in batches:
                for b, _, scale, seen, change in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if b != block:
                        if block is not None:
                            yield mean()
                        block, n, total = b, np.zeros(BLOCK), np.zeros((BLOCK, BRANCH))
                    n += np.frombuffer(seen, np.float32)
                    total += np.frombuffer(change, np.float16).reshape(BLOCK, BRANCH).astype(np.float64) * scale
            if block is not None:
                yield mean()

        changes = rows.where(F.col("part") == turn).select("text").mapInArrow(descend, "block int, task int, scale double, seen binary, change binary")
        means = changes.repartition("block").sortWithinPartitions("block", "task").mapInArrow(combine, "block int, mean binary").toArrow()
        weights = model.weights.copy()
        for b, mean in zip(means.column("block").to_pylist(), means.column("mean").to_pylist(), strict=True):
            k = b % per_table
            weights[b // per_table, k * BLOCK : (k + 1) * BLOCK] += np.frombuffer(mean, np.float32).reshape(BLOCK, BRANCH)
        model = Model(levels, weights)
        begun.unpersist()
    return model


def build_vocabulary(counts: DataFrame) -> Vocabulary:
    """From ``token, n``: the ``KNOWN`` most frequent words of ``KNOWN_BYTES`` at most, and figures of all words by the leaf of their ending."""
    size = F.octet_length("token")
    levels = levels_for(counts.count())
    shared = (BRANCH - OWN) * BRANCH ** (levels - 1)
    ending = F.when(size < ENDING, F.col("token")).otherwise(F.substring("token", -ENDING, ENDING))
    by_leaf = counts.groupBy(F.pmod(F.crc32(ending), F.lit(shared)).alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).toArrow()
    words, types = np.zeros(shared), np.zeros(shared)
    at = by_leaf.column("c").to_numpy()
    words[at], types[at] = by_leaf.column("n").to_numpy(), by_leaf.column("types").to_numpy()
    top = counts.where(size <= KNOWN_BYTES).orderBy(F.desc("n"), "token").limit(KNOWN).toArrow()
    return Vocabulary([bytes(t) for t in top.column("token").to_pylist()], top.column("n").to_pylist(), levels, words, types)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, fold: int = 1, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Rows whose crc32(id as text) mod ``folds`` is ``fold`` are held out; counts and
    weights are learnt from the others. ``base_score`` is the smoothed unigram log10
    probability of the whole text and its end, ``score`` the model's. Null and empty
    texts are their end alone. A null id counts as the empty text in crc32. Repeated
    rows count and are scored each. Without training rows every token is unknown. An
    empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    held_out = crc_mod(F.col(id_col), folds) == fold
    turn = F.pmod(F.floor(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) / F.lit(folds)), F.lit(rounds)).cast("int")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), turn.alias("part"), binary_text(F.col(text_col)).alias("text"))
    learnt = rows.where(~F.col("held_out"))
    counts = materialize(count_tokens(learnt), "counts")
    vocabulary = build_vocabulary(counts)
    model = train(learnt, vocabulary, rounds)
    shared = spark.sparkContext.broadcast((vocabulary, model.weights))

    @handing_back
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = shared.value
        own = Model(words.levels, weights)
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 40
        for batch in batches:
            for a, b, texts in _chunks(batch.column(2)):
                tokens, ids, key, leaf, sizes = words.encode(texts)
                start = np.cumsum(sizes) - sizes
                listed = ids >= 0
                part = own.log10(words, key, leaf, sizes)
                smooth = np.where(listed, words.log_count[ids], 0.0)
                ending = leaf >= words.first_shared
                part[ending] += smooth[ending]
                rare: list[list[bytes]] = [[] for _ in texts]
                doc = np.repeat(np.arange(len(texts)), sizes)
                at = np.flatnonzero(~listed)
                for i, d in zip(at.tolist(), doc[at].tolist(), strict=True):
                    rare[d].append(tokens[i])
                bags = [Counter(x) for x in rare]
                columns = [
                    pa.array(np.arange(row, row + len(texts))),
                    batch.column(0).slice(a, b - a),
                    batch.column(1).slice(a, b - a),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(np.add.reduceat(listed, start).astype(np.int64)),
                    pa.array(np.add.reduceat(smooth, start)),
                    pa.array(np.add.reduceat(part, start)),
                    pa.array([list(x) for x in bags], pa.list_(pa.binary())),
                    pa.array([list(x.values()) for x in bags], pa.list_(pa.int64())),
                ]
                row += len(texts)
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "held_out", "n_tokens", "known", "base", "model", "rare", "times"])

    scored = rows.select("doc_id", "held_out", "text").mapInArrow(
        score, "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double, rare array<binary>, times array<long>"
    )
    scored = materialize(scored, "scored")
    pairs = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("p")).select("row", F.col("p.rare").alias("token"), F.col("p.times").alias("times"))
    found = pairs.join(counts, "token", "left")
    sums = found.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_base"), F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("rare_known")
    )
    zero = F.lit(0.0)
    n, v = vocabulary.total, vocabulary.distinct
    base = F.col("base") + F.coalesce("rare_base", zero) - F.col("n_tokens") * F.lit(math.log10(n + 0.5 * (v + 1)))
    return scored.drop("rare", "times").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("model") + F.coalesce("rare_base", zero)).alias("score"),
    )


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))
