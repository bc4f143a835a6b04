"""N-gram Jaccard self-join by chosen paths.

Every text becomes the set of its ``WIDTH``-word shingles and an embedding of
``TOKENS`` min-hash tokens; two sets of similarity s share a token with probability s.
A record starts as many walks as the target recall takes. At each step it follows the tokens whose hash,
salted with the path so far, is among the chosen ones (``PICKS`` expected): records that
share a chosen token land in the same bucket. Buckets above ``LIMIT`` split again on further
tokens while all of them together ask for more than ``LIMIT / 2`` comparisons a class; buckets whose
records resemble each other, which splitting would not shrink, and all others are searched by brute
force, large ones in pairs of blocks. A pair of
similarity 0.8 meets in a run with probability 0.80 at the first step, 0.72 over two, 0.69
over three and 0.65 over ten. ``runs_for`` derives the number of walks from the target
``RECALL`` at the similarity asked for and the survival over ``DEPTH`` steps, the worst
that a bucket can ask for; pairs above that similarity are found more surely.

Sets that are equal are one class from the start. A pair of classes is examined only in the
first of their common buckets, its full shingle sets decide, and what leaves a bucket are
counts and a spanning forest, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_text, byte_slices, discard, flat_bytes, handing_back, materialize, read_table

WIDTH = 5
SIMILARITY = 0.8
TOKENS = 128
PICKS = 2.0
#: Least probability with which a pair of the similarity asked for is found.
RECALL = 0.998
LIMIT = 256
DENSE = 0.5
DEPTH = 10
#: Records of a block, and shingles of all of them (8 MB), on average.
BLOCK = 2048
BLOCK_SHINGLES = 1 << 20
#: Parts of more records are compared one by one; pairs held at once while their full sets are compared.
SMALL_PART = 16
HELD_PAIRS = 1 << 20
#: Records that a task compares at once: whole parts of buckets, about 2 * BLOCK at most each.
PART_ROWS = 8192
#: Leading tokens of a sketch (their lowest bytes) by which a bucket's likeness is judged.
BRIEF = 16
#: A sketch of 128 tokens underrates a similarity of 0.8 by 0.16 or more once in 30,000 pairs.
SLACK = 0.16
BATCH_BYTES = 1 << 18
#: Keys of rows to verify that are broadcast at most (4 MB); more are joined by a shuffle.
BROADCAST_KEYS = 500_000

_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _K1
    h = (h ^ (h >> np.uint64(29))) * _K2
    return h ^ (h >> np.uint64(32))


def _seeds(n: int, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(np.arange(1, n + 1, dtype=np.uint64) * _K3 + np.uint64(salt)) | np.uint64(1)


_INVERSE = np.uint64(pow(int(_K1), -1, 1 << 64))


_kept_powers: dict[int, np.ndarray] = {}


def _powers(n: int, base: np.uint64) -> np.ndarray:
    """The first ``n`` powers; those that a slice of texts needs are kept."""
    most = max(n, 2 * BATCH_BYTES)
    kept = _kept_powers.get(int(base))
    if kept is None or len(kept) < n:
        kept = np.full(most, base)
        kept[0] = 1
        kept = np.multiply.accumulate(kept)
        if most == 2 * BATCH_BYTES:
            _kept_powers[int(base)] = kept
    return kept[:n]


def shingles(flat: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, end to end; and their n+1 offsets.

    Words are runs of bytes other than white space, A-Z in lower case. A text of fewer
    words than ``width``, but some, has one shingle: all its words.
    """
    n = len(offsets) - 1
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    flat = _LOWER[flat]
    space = _SPACE[flat]
    edge = np.zeros(len(flat) + 1, bool)
    edge[offsets] = True
    begins = ~space
    begins[1:] &= space[:-1] | edge[1:-1]
    ends = ~space
    ends[:-1] &= space[1:] | edge[1:-1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends)
    total = np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * _powers(len(flat), _K1), dtype=np.uint64)
    inverse = _powers(len(flat), _INVERSE)
    word = total[end]
    word[1:] -= total[begin[1:] - 1]
    if len(begin) and begin[0] > 0:
        word[0] -= total[begin[0] - 1]
    word = _mix(word * inverse[begin] + (end - begin + 1).astype(np.uint64))
    owner = np.searchsorted(offsets, begin, side="right") - 1
    words = np.bincount(owner, minlength=n)
    first = np.cumsum(words) - words
    count = np.where(words >= width, words - width + 1, (words > 0).astype(np.int64))
    coefficient = _seeds(width, 77)
    out, sizes = [], np.zeros(n, np.int64)
    padded = np.concatenate([word, np.zeros(width, np.uint64)])
    combined = sum((padded[i : i + len(word)] * coefficient[i] for i in range(width)), np.zeros(len(word), np.uint64))
    combined = _mix(combined)
    for i in range(n):
        if words[i] >= width:
            own = np.unique(combined[first[i] : first[i] + count[i]])
        elif words[i]:
            own = _mix((word[first[i] : first[i] + words[i]] * coefficient[: words[i]]).sum(keepdims=True) + np.uint64(words[i]))
        else:
            continue
        out.append(own)
        sizes[i] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def embed(sets: np.ndarray, offsets: np.ndarray, tokens: int = TOKENS) -> np.ndarray:
    """Min-hash tokens (rows: non-empty sets in order)."""
    full = np.flatnonzero(np.diff(offsets))
    out = np.empty((len(full), tokens), np.uint32)
    if len(full):
        start, high, hashed = offsets[:-1][full], sets >> np.uint64(31), np.empty_like(sets)
        for k, seed in enumerate(_seeds(tokens, 5)):
            np.bitwise_xor(sets, seed, out=hashed)
            np.multiply(hashed, seed, out=hashed)
            np.bitwise_xor(hashed, high, out=hashed)
            out[:, k] = np.minimum.reduceat(hashed, start) >> np.uint64(32)
    return out


def _children(path: np.ndarray, sketch: np.ndarray, picks: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and next paths of the tokens that each record follows from its path."""
    tokens = sketch.shape[1]
    h = _mix((path[:, None] + _seeds(tokens, 31)[None, :]) ^ (sketch.astype(np.uint64) * _K2))
    row, _ = np.nonzero(h < np.uint64(min(1.0, picks / tokens) * (2**64 - 2**12)))
    return row, _mix(h[h < np.uint64(min(1.0, picks / tokens) * (2**64 - 2**12))] + _K3)


def runs_for(recall: float, similarity: float, picks: float = PICKS, tokens: int = TOKENS, depth: int = DEPTH) -> int:
    """Walks after which a pair of ``similarity`` is found with probability ``recall``, however deep its buckets split.

    Walks of a pair are independent only given the number of tokens that its sketches have
    in common: what is lost is averaged over that number, which also has to pass ``SLACK``.
    """
    common = np.arange(tokens + 1)
    weight = np.array([math.comb(tokens, k) * similarity**k * (1 - similarity) ** (tokens - k) for k in range(tokens + 1)])
    weight[common < (similarity - SLACK) * tokens] = 0
    lost = np.zeros(tokens + 1)
    for _ in range(depth):
        lost = (1 - min(1.0, picks / tokens) * (1 - lost)) ** common
    if recall >= weight[lost < 1].sum():
        raise ValueError(f"no number of walks reaches a recall of {recall} at a similarity of {similarity}")
    runs = 1
    while (weight * (1 - lost**runs)).sum() < recall:
        runs += 1
    return runs


def _packed(sketch: np.ndarray) -> np.ndarray:
    """Tokens as bytes, planes of equal significance together: the first ``TOKENS`` bytes are the lowest of each."""
    return np.ascontiguousarray(sketch.astype("<u4").view(np.uint8).reshape(len(sketch), -1, 4).transpose(0, 2, 1)).reshape(len(sketch), -1)


def _sketches(column: pa.Array) -> np.ndarray:
    flat, offsets = flat_bytes(column)
    if not len(flat):
        return np.zeros((0, TOKENS), np.uint32)
    planes = flat.reshape(len(offsets) - 1, 4, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4")[:, :, 0]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _key(text: Column) -> Column:
    """What tells a row from others of its id, or without one: a hash of its text."""
    return F.xxhash64(binary_text(text))


def _sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``doc_id, key, class`` (16 bytes that name the set; null without words), ``n, sketch``."""

    @handing_back
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = flat_bytes(batch.column(2))
            for a, b in byte_slices(np.diff(offsets), BATCH_BYTES):
                sets, at = shingles(flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                n = np.diff(at)
                full = np.flatnonzero(n)
                names = np.zeros((len(full), 2), np.uint64)
                if len(full):
                    names[:, 0] = np.add.reduceat(_mix(sets + _K2), at[:-1][full])
                    names[:, 1] = np.add.reduceat(_mix(sets ^ _K3), at[:-1][full])
                sketch = _packed(embed(sets, at))
                name, tokens = [None] * (b - a), [None] * (b - a)
                for k, i in enumerate(full.tolist()):
                    name[i], tokens[i] = names[k].tobytes(), sketch[k].tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(name, pa.binary()), pa.array(n), pa.array(tokens, pa.binary())], ["doc_id", "key", "class", "n", "sketch"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(F.col(text_col)).alias("key"), binary_text(F.col(text_col)).alias("text"))
    return rows.mapInArrow(build, "doc_id long, key long, class binary, n long, sketch binary")


def _step(rows: DataFrame, picks: float, runs: int) -> DataFrame:
    """``class, n, path`` one step on from ``class, sketch, n, paths``, or from the start where there are no paths."""
    start = "paths" not in rows.columns

    @handing_back
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketch = _sketches(batch.column(1))
            if start:
                at, paths = np.tile(np.arange(len(sketch)), runs), np.repeat(_seeds(runs, 11), len(sketch))
            else:
                at, paths = np.repeat(np.arange(len(sketch)), np.diff(batch.column(3).offsets.to_numpy())), batch.column(3).flatten().to_numpy().view(np.uint64)
            for a in range(0, len(at), 4096):
                row, to = _children(paths[a : a + 4096], sketch[at[a : a + 4096]], picks)
                own = pa.array(at[a : a + 4096][row])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(2).take(own), _signed(to)], ["class", "n", "path"])

    return rows.mapInArrow(walk, "class binary, n int, path long")


def _gathered(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``nodes`` that are in some bucket of ``members``, with their ``paths``: a class meets its sketch once, in however many buckets it is."""
    return members.groupBy("class").agg(F.collect_list("path").alias("paths")).join(nodes, "class")


def _nodes(sets: DataFrame) -> DataFrame:
    """The classes: ``class, sketch, n, copies, row`` (a hash of one row's id and text)."""
    return sets.groupBy("class").agg(F.first("sketch").alias("sketch"), F.first("n").cast("int").alias("n"), F.count(F.lit(1)).alias("copies"), F.min(F.xxhash64("doc_id", "key")).alias("row"))


def _few(df: DataFrame) -> bool:
    return df.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS


def _likeness(members: DataFrame, big: DataFrame, nodes: DataFrame) -> DataFrame:
    """``path, like`` of each bucket of ``big``: mean share of the leading tokens that its records have in common with one of them.

    ``big`` has one row a bucket and is broadcast if it is small, so a bucket's records stay where they are.
    """
    brief = F.substring("sketch", 1, BRIEF)
    pivots = big.join(nodes.select(F.xxhash64("class").alias("lowest"), brief.alias("pivot")), "lowest").groupBy("path").agg(F.min("pivot").alias("pivot"))
    pivots = materialize(pivots, "pivots")
    held = _gathered(members, nodes.select("class", brief.alias("brief"))).select("brief", F.explode("paths").alias("path"))
    own = held.join(F.broadcast(pivots) if _few(pivots) else pivots, "path").select("path", "brief", "pivot")

    @handing_back
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (flat_bytes(batch.column(i))[0].reshape(-1, BRIEF) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((a == b).mean(1))], ["path", "like"])

    return own.mapInArrow(compare, "path long, like double").groupBy("path").agg(F.avg("like").alias("like"))


def _buckets(nodes: DataFrame, picks: float, runs: int, limit: int, depth: int, block: int) -> DataFrame:
    """``class, path, blocks``: the final buckets of two classes or more, the classes in them, and how many blocks each is compared in."""
    rows, done = _step(nodes.select("class", "sketch", "n"), picks, runs), None
    worth = nodes.count() * limit / 2
    pairs = F.sum(F.col("held") * (F.col("held") - 1.0) / 2)
    for level in range(depth):
        rows = materialize(rows, "walk")
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("n"), F.min(F.xxhash64("class")).alias("lowest")).where("held > 1")
        sizes = materialize(sizes.withColumn("blocks", F.ceil(F.greatest(F.col("held") / F.lit(block), F.col("n") / F.lit(BLOCK_SHINGLES))).cast("int")).drop("n"), "sizes")
        # One row a bucket against its records: a bucket of very many is split by Spark, as nothing above the join asks for its key.
        live = materialize(rows.join(sizes.select("path", "held", "blocks").hint("merge"), "path"), "live")
        discard(rows)
        big = sizes.where(F.col("held") > limit)
        split = level + 1 < depth and (big.agg(pairs).first()[0] or 0) > worth
        if split:
            like = _likeness(live.where(F.col("held") > limit), big, nodes)
            loose = materialize(like.where(F.col("like") < DENSE).select("path").join(big.select("path", "held"), "path"), "like")
            split = (loose.agg(pairs).first()[0] or 0) > worth
        if not split:
            done = live if done is None else done.unionByName(live)
            break
        splits = loose.select("path")
        splits = F.broadcast(splits) if _few(splits) else splits
        stay, go = live.join(splits, "path", "left_anti"), live.join(splits, "path", "left_semi")
        done = stay if done is None else done.unionByName(stay)
        rows = _step(_gathered(go, nodes.select("class", "sketch", "n")).select("class", "sketch", "n", "paths"), picks, runs)
    return done.select("class", "path", "blocks")


def _in_blocks(members: DataFrame) -> DataFrame:
    """Adds ``a, b, block``: every unordered pair of blocks of a bucket; a record is of block a or b in its parts."""
    blocks = F.col("blocks")
    own = F.pmod(F.xxhash64("class", "path"), blocks).cast("int")
    return members.withColumn("block", own).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumns({"a": F.least("block", "_other"), "b": F.greatest("block", "_other")}).drop("_other", "blocks")


def _whole_parts(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Runs of whole parts (equal ``path, a, b``, sorted), of ``rows`` records or a little more; and the edges of the parts."""

    def edges(t: pa.Table) -> np.ndarray:
        new = np.zeros(len(t), bool)
        new[:1] = True
        for c in ("path", "a", "b"):
            x = t.column(c).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= rows:
            table = pa.Table.from_batches(held)
            at = edges(table)
            if len(at) > 1:
                yield table.slice(0, at[-1]), at
                held = table.slice(at[-1]).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        if len(table):
            yield table, np.append(edges(table), len(table))


def _pairs(edges: np.ndarray, block: np.ndarray, a: np.ndarray, b: np.ndarray, most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Record numbers of all pairs within each part, about ``most`` at a time."""
    size, first = np.diff(edges), edges[:-1]
    same = a[first] == b[first]
    for n in np.unique(size[same & (size <= SMALL_PART)]).tolist():
        x, y = np.triu_indices(n, 1)
        own = first[same & (size == n)]
        step = max(1, most // max(1, len(x)))
        for i in range(0, len(own), step):
            yield (own[i : i + step, None] + x).ravel(), (own[i : i + step, None] + y).ravel()
    for i in np.flatnonzero(~same | (size > SMALL_PART)).tolist():
        at = np.arange(edges[i], edges[i + 1])
        if same[i]:
            near = far = at
        else:
            near, far = at[block[at] == a[at]], at[block[at] == b[at]]
        if not len(far):
            continue
        step = max(1, most // len(far))
        for k in range(0, len(near), step):
            x, y = np.repeat(near[k : k + step], len(far)), np.tile(far, len(near[k : k + step]))
            if same[i]:
                later = y > x
                x, y = x[later], y[later]
            yield x, y


def _masks(paths: pa.Array, path: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A bit for each bucket before its own that a record has in common with another one of its part."""
    offsets = paths.offsets.to_numpy().astype(np.int64)
    flat = paths.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    owner = np.repeat(np.arange(len(path)), np.diff(offsets))
    keep = flat < path[owner]
    flat, owner = flat[keep], owner[keep]
    part = np.searchsorted(edges, owner, side="right") - 1
    order = np.lexsort((flat, part))
    flat, owner, part = flat[order], owner[order], part[order]
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (part[1:] != part[:-1])
    group = np.cumsum(new) - 1
    several = np.flatnonzero(np.bincount(group) > 1)
    within = part[new][several]
    bit = np.full(int(new.sum()), -1)
    bit[several] = np.arange(len(several)) - np.searchsorted(within, within)
    bit = bit[group]
    owner, bit = owner[bit >= 0], bit[bit >= 0]
    masks = np.zeros((int(bit.max(initial=0)) // 64 + 1, len(path)), np.uint64)
    np.bitwise_or.at(masks, (bit // 64, owner), np.uint64(1) << (bit % 64).astype(np.uint64))
    return masks


def _near(table: pa.Table, edges: np.ndarray, lowest: float, most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of each part that are alike by their sketches and in no earlier bucket."""
    column = {c: table.column(c).combine_chunks() for c in ("path", "a", "b", "block", "low", "paths")}
    low = flat_bytes(column["low"])[0].reshape(len(table), -1)
    path, a, b, block = (column[c].to_numpy() for c in ("path", "a", "b", "block"))
    masks = _masks(column["paths"], path, edges)
    for x, y in _pairs(edges, block, a, b, most):
        good = np.zeros(len(x), bool)
        for i in range(0, len(x), 8192):
            equal = np.packbits(low[x[i : i + 8192]] == low[y[i : i + 8192]], axis=1).view(np.uint64)
            good[i : i + 8192] = np.bitwise_count(equal).sum(1) >= lowest * low.shape[1]
        x, y = x[good], y[good]
        met = np.zeros(len(x), bool)
        for mask in masks:
            met |= mask[x] & mask[y] != 0
        yield x[~met], y[~met]


def _common(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets."""
    out = np.empty(len(x), np.int64)
    for i, (a, b) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
        few, many = (sets[a], sets[b]) if len(sets[a]) < len(sets[b]) else (sets[b], sets[a])
        at = np.searchsorted(many, few)
        at[at == len(many)] = 0
        out[i] = np.count_nonzero(many[at] == few)
    return out


def _common_dense(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The same for many pairs of few sets, by matrix products over ranges of elements of bounded size."""
    rows, row = np.unique(x, return_inverse=True)
    columns, column = np.unique(y, return_inverse=True)
    which = np.unique(np.concatenate([rows, columns]))
    row_at, column_at = np.searchsorted(which, rows), np.searchsorted(which, columns)
    own = [sets[i] for i in which.tolist()]
    ranges = max(1, -(-sum(map(len, own)) // (1 << 19)))
    bounds = np.arange(1, ranges, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // ranges)  # half of the range is no signed number
    cuts = np.array([[0, *np.searchsorted(s, bounds).tolist(), len(s)] for s in own])
    shared = np.zeros((len(rows), len(columns)), np.float32)
    for r in range(ranges):
        parts = [s[c[r] : c[r + 1]] for s, c in zip(own, cuts, strict=True)]
        owner = np.repeat(np.arange(len(own)), [len(q) for q in parts])
        _, code, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        several = np.flatnonzero(counts > 1)
        number = np.full(len(counts), -1)
        number[several] = np.arange(len(several))
        at = number[code]
        for c in range(0, len(several), 2048):
            hit = (at >= c) & (at < c + 2048)
            table = np.zeros((len(own), min(2048, len(several) - c)), np.float32)
            table[owner[hit], at[hit] - c] = 1
            shared += table[row_at] @ table[column_at].T
    return shared[row, column].astype(np.int64)


def _forest(parent: list[int], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that join trees of the forest ``parent``, which grows by them."""

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(left.tolist(), right.tolist(), strict=True):
        a, b = root(x), root(y)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append((x, y))
    return kept


def _links(buckets: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, similarity: float) -> DataFrame:
    """``class, links`` (a class's weight of links found) and ``other`` (forest edges, links 0)."""
    lowest = similarity - SLACK
    own = buckets.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("path", "blocks"))).alias("own"))
    known = nodes.select("class", F.substring("sketch", 1, TOKENS).alias("low"), "copies")
    members = own.join(known.hint("merge"), "class").select("class", "low", "copies", F.col("own.path").alias("paths"), F.explode("own").alias("at"))
    members = _in_blocks(members.select("class", "low", "copies", "paths", "at.path", "at.blocks"))
    part, kept = ["path", "a", "b"], ["class", "path", "a", "b", "block", "copies", "low", "paths"]
    types = "class binary, path long, a int, b int, block int, copies long, low binary, paths array<long>"

    @handing_back
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in _whole_parts(batches, PART_ROWS):
            active = np.zeros(len(table), bool)
            for x, y in _near(table, edges, lowest):
                active[x] = active[y] = True
            yield from table.take(pa.array(np.flatnonzero(active))).combine_chunks().to_batches()

    # A part has about 2 * block records at most, however large its bucket.
    active = members.select(*kept).repartition(*part).sortWithinPartitions(*part).mapInArrow(near, types)
    active = materialize(active, "active")

    # The full sets of the classes that have a partner by their sketches, from one row of each.
    wanted = active.select("class").distinct()
    chosen = materialize(wanted.join(nodes.select("class", "row").hint("merge"), "class").select("row").distinct(), "chosen")
    texts = docs.select(F.xxhash64(F.col(id_col).cast("long"), _key(F.col(text_col))).alias("row"), binary_text(F.col(text_col)).alias("text"))
    texts = texts.join(F.broadcast(chosen) if _few(chosen) else chosen, "row", "left_semi")

    @handing_back
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = flat_bytes(batch.column(0))
            for a, b in byte_slices(np.diff(offsets), BATCH_BYTES):
                sets, at = shingles(flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                found = {}
                for i in range(b - a):
                    own = sets[at[i] : at[i + 1]]
                    found[np.array([_mix(own + _K2).sum(), _mix(own ^ _K3).sum()], np.uint64).tobytes()] = own.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], ["class", "elements"])

    full = materialize(texts.select("text").mapInArrow(whole, "class binary, elements binary"), "full")
    if full.count() > full.select("class").distinct().count():  # rows of the same id and text
        full = full.dropDuplicates(["class"])

    @handing_back
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in _whole_parts(batches, 1):
            flat, offsets = flat_bytes(table.column("elements").combine_chunks())
            elements = flat.view(np.uint64)
            sets = [elements[a:b] for a, b in zip(offsets[:-1] // 8, offsets[1:] // 8, strict=True)]
            size = np.diff(offsets) // 8
            weight = table.column("copies").to_numpy()
            links = np.zeros(len(table), np.int64)
            parent, forest = list(range(len(table))), []
            for x, y in _near(table, edges, lowest, HELD_PAIRS):
                # Sets of which one is smaller than the similarity allows need no comparison.
                fits = np.minimum(size[x], size[y]) >= similarity * np.maximum(size[x], size[y]) - 1e-9
                x, y = x[fits], y[fits]
                if not len(x):
                    continue
                own = np.searchsorted(edges, x[[0, -1]], side="right")
                one = own[0] == own[1] and len(x) > 8 * (own_size := edges[own[0]] - edges[own[0] - 1]) and own_size > SMALL_PART
                shared = (_common_dense if one else _common)(sets, x, y)
                good = shared >= similarity * (size[x] + size[y] - shared) - 1e-9
                x, y = x[good], y[good]
                np.add.at(links, x, weight[y])
                np.add.at(links, y, weight[x])
                forest += _forest(parent, x, y)
            name = table.column("class").to_pylist()
            some = np.flatnonzero(links).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name[i] for i in some] + [name[x] for x, _ in forest], pa.binary()), pa.array(links[some].tolist() + [0] * len(forest), pa.int64()), pa.array([None] * len(some) + [name[y] for _, y in forest], pa.binary())], ["class", "links", "other"]
            )

    ready = active.join(full.hint("merge"), "class").repartition(*part).sortWithinPartitions(*part)
    return materialize(ready.select(*kept, "elements").mapInArrow(verify, "class binary, links long, other binary"), "links")


def _chained(edges: DataFrame) -> bool:
    """Whether a vertex ``a`` has several edges ``a, b`` or is another one's ``b``."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("e")).select("e.*")
    met = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return bool(met.where("up > 1 or up = 1 and least = 0").limit(1).count())


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of each component, by alternating large and small stars until every edge leads to the centre of a star.

    ``edges`` has ``a, b``. Each round writes its edges to the shared folder; a vertex sends its
    edges to its smallest neighbour, so no vertex gathers a component.
    """
    work = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    while _chained(work):
        both = work.unionByName(work.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = materialize(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        small = materialize(small, "small")
        discard(large), discard(work)
        work = small
    return work.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, similarity: float, width: int, picks: float, recall: float, limit: int, block: int, depth: int
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``_sets``; and ``class, first, copies, links``, ``first`` being the row that stands
    for the class's component: ``unnamed`` (its id is null), ``doc_id, key``, the smallest."""
    sets = materialize(_sets(docs, id_col, text_col, width), "sets")
    worded = sets.where("class is not null")
    nodes = materialize(_nodes(worded), "nodes")
    buckets = _buckets(nodes, picks, runs_for(recall, similarity, picks, TOKENS, depth), limit, depth, block)
    links = _links(buckets, nodes, docs, id_col, text_col, width, similarity)
    sums = links.where("other is null").groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(links.where("other is not null").select(F.col("class").alias("a"), F.col("other").alias("b")))
    roots = materialize(roots, "roots")
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    small = worded.groupBy("class").agg(F.min(row).alias("own"), F.count(F.lit(1)).alias("copies"))
    rooted = small.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    named = rooted.groupBy("root").agg(F.min("own").alias("first"))
    return sets, rooted.join(named, "root").join(sums, "class", "left").select("class", "first", "copies", F.coalesce("links", F.lit(0)).alias("links"))


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    width: int = WIDTH,
    picks: float = PICKS,
    recall: float = RECALL,
    limit: int = LIMIT,
    block: int = BLOCK,
    depth: int = DEPTH,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, n_links, n_copies, n_shingles``.

    ``class_id`` is the smallest doc_id of the row's connected component of links;
    ``n_links`` the number of other rows of similarity ``similarity`` or more, equal sets
    included, each found with probability ``recall`` at least; ``n_copies`` the rows with the same set, itself included. Texts without a
    word (null, empty) link to nothing and are classes of their own. Repeated rows are
    copies of each other. Null ids are no class's name unless all its ids are null. An
    empty table gives an empty result.
    """
    sets, told = _grouped(docs, id_col, text_col, similarity, width, picks, recall, limit, block, depth)
    return sets.select("doc_id", "class", "n").join(told, "class", "left").select(
        "doc_id",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.col("n").alias("n_shingles"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` of each component of links, and all rows without a word.

    A component keeps a row of its smallest id, a null id only where all its ids are null.
    Rows are told apart by id and text: an id that repeats with other texts loses only
    those that another row stands for, and of rows equal in both one stays.
    """
    sets, told = _grouped(docs, id_col, text_col, SIMILARITY, WIDTH, PICKS, RECALL, LIMIT, BLOCK, DEPTH)
    rows = sets.join(told, "class").select("doc_id", "key", (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))).alias("stays"))
    apart = materialize(rows.groupBy("doc_id", "key").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("times")).where("not stays or times > 1"), "apart")

    def of(some: DataFrame, how: str) -> DataFrame:
        return docs.join(some, docs[id_col].cast("long").eqNullSafe(some["doc_id"]) & (_key(docs[text_col]) == some["key"]), how)

    once = of(apart, "left_anti")
    twice = apart.where("stays")
    if not twice.limit(1).count():
        return once
    again = of(twice, "left_semi").select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), _key(F.col(text_col)).alias("key"))
    return once.unionByName(again.dropDuplicates(["doc_id", "key"]).select("row.*"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
