"""The most alike pairs of vectors of different groups, by bounds on norms and prefixes.

Vectors, scaled to length 1, are assigned to the nearest of some pivots; a cell is written with
its widest angle. The best pairs within each piece of a cell give a first bound. Two cells
whose angle, less their widths, allows no pair above it are never compared. Cells, or parts of large
ones, are packed into blocks, of which there are a fixed number until they fill ``BLOCK_BYTES``: a vector is
sent once for each block that it may meet, so what is sent grows with the vectors, not with their
square. Within a task pieces are multiplied in single precision, first a prefix of the columns where that pays: a row whose
best sum so far plus the product of the remaining norms stays below the bound is given up. Pairs that
reach the bound, less the error of such products, are multiplied once more in double precision.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import cut, drop

#: Vectors of a piece, pivots at most, columns of a block.
PIECE = 1024
PIVOTS = 512
COLUMNS = 16
#: Blocks of vectors, about; and bytes of a block at most, beyond which there are more of them.
BLOCKS = 24
BLOCK_BYTES = 64 << 20
_PAIRS = "a long, b long, cosine double"


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


class _Units:
    """The vectors of a task by unit and id: ``ids``, ``groups`` (numbered), ``x``, ``single`` (x in single precision), and ``span``, the rows of each unit."""

    def __init__(self, table: pa.Table):
        unit, ids = table["unit"].to_numpy(), table["id"].to_numpy()
        at = np.lexsort((ids, unit))
        self.ids, self.x = ids[at], _rows(table["v"])[at] if len(at) else np.zeros((0, 1))
        self.groups = table["kind"].combine_chunks().dictionary_encode().indices.to_numpy()[at]
        self.single = self.x.astype(np.float32)
        cuts = [0, *(np.flatnonzero(np.diff(unit[at])) + 1).tolist(), len(at)]
        self.span = {int(unit[at[a]]): (a, b) for a, b in itertools.pairwise(cuts) if b > a}

    def rests(self, columns: int) -> tuple[np.ndarray, list[int]]:
        """Norms of what is left of each vector after so many columns, and those numbers of columns."""
        stops = list(range(columns, self.x.shape[1], columns))
        return np.stack([np.linalg.norm(self.x[:, s:], axis=1) for s in stops], axis=1) if stops else np.zeros((len(self.x), 0)), stops


def _table(a: np.ndarray, b: np.ndarray, score: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "cosine": pa.array(score, pa.float64())})


def _best(a: np.ndarray, b: np.ndarray, score: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.lexsort((b, a, -score))[:most]
    return a[at], b[at], score[at]


def _compare_units(units: _Units, meets: Iterator[tuple[int, list[int]]], bound: float, most: int, piece: int, columns: int) -> pa.Table:
    """The ``most`` best pairs, at ``bound`` or more, of each unit of ``meets`` with the units listed for it, or with itself where it is listed.

    Products in single precision, whose error is ``slack`` at most, tell which pairs are worth an exact product.
    Once ``most`` pairs are found, the least of them is the bound of the pieces to come. Rows are left
    out by a prefix of the columns as long as that leaves out half of a pair of pieces.
    """
    slack = (units.x.shape[1] + 8) * 2.0**-23
    best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    rests, stops = units.rests(columns)
    buffer = np.empty(piece * piece, np.float32)
    exact = max(1, (16 << 20) // (8 * units.x.shape[1]))

    def likely(left: np.ndarray, right: np.ndarray, low: float, stop: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
        """Rows of both, and products, of the pairs at ``low`` or more; and whether the prefix has left out half of them or more."""
        spared = False
        if stop is not None:
            x, y = rests[left, stop], rests[right, stop]
            part = units.single[left, : stops[stop]] @ units.single[right, : stops[stop]].T
            rows, others = part.max(1) + x * y.max() >= low, part.max(0) + y * x.max() >= low
            spared = 2 * rows.sum() * others.sum() <= part.size
            left, right = left[rows], right[others]
        out = np.matmul(units.single[left], units.single[right].T, out=buffer[: len(left) * len(right)].reshape(len(left), len(right)))
        rows = np.flatnonzero(out.max(1) >= low) if out.size else np.zeros(0, np.int64)
        i, j = np.nonzero(out[rows] >= low)
        return left[rows[i]], right[j], out[rows[i], j], spared

    for c, others in meets:
        own = np.arange(*units.span[c])
        # A unit met with itself comes last, so that the rows of all others are cut into whole pieces.
        far = np.concatenate([np.arange(*units.span[d]) for d in others if d != c] or [own[:0]])
        tiles = [(x, y, False) for x in _pieces(own, piece) for y in _pieces(far, piece)]
        if c in others:
            cuts = _pieces(own, piece)
            tiles += [(x, y, x is y) for k, x in enumerate(cuts) for y in cuts[k:]]
        by_prefix = True
        for x, y, same in tiles:
            low = bound - slack
            stop = next((k for k in range(len(stops)) if rests[x, k].max() * rests[y, k].max() < low), None) if by_prefix else None
            i, j, score, spared = likely(x, y, low, stop)
            by_prefix = by_prefix and (stop is None or spared)
            live = (units.groups[i] != units.groups[j]) & (units.ids[i] != units.ids[j])
            if same:
                live &= i < j
            i, j, score = i[live], j[live], score[live]
            if len(i) > most:
                enough = score >= np.partition(score, -most)[-most] - 2 * slack
                i, j = i[enough], j[enough]
            for k in range(0, len(i), exact):
                left, right = i[k : k + exact], j[k : k + exact]
                score = np.einsum("ij,ij->i", units.x[left], units.x[right])
                a, b = units.ids[left], units.ids[right]
                keep = score >= bound - 1e-12
                found = np.minimum(a, b)[keep], np.maximum(a, b)[keep], score[keep]
                best = _best(*(np.concatenate(z) for z in zip(best, found, strict=True)), most)
                if len(best[0]) == most:
                    bound = max(bound, best[2][-1])
    return _table(*best)


def _pieces(rows: np.ndarray, piece: int) -> list[np.ndarray]:
    """Equal parts of ``piece`` rows at most."""
    return np.array_split(rows, -(-len(rows) // piece)) if len(rows) else []


def _layout(cells: dict[int, int], near: np.ndarray, rows: int) -> list[tuple[int, int, int]]:
    """``cell, part, block`` of each unit: a part of a cell of ``rows`` vectors at most, about; units are packed into blocks of so many, near cells together."""
    left, at = sorted(cells), None
    out, block, held = [], 0, 0
    while left:
        at = left[0] if at is None else max(left, key=lambda c: near[at, c])
        left.remove(at)
        parts = -(-cells[at] // rows)
        size = cells[at] / parts
        for part in range(parts):
            if held and held + size > rows:
                block, held = block + 1, 0
            out.append((at, part, block))
            held += size
    return out


def top_pairs(vectors: DataFrame, id_: str, vector: str, group: str, most: int, piece: int = PIECE, pivots: int = PIVOTS, columns: int = COLUMNS) -> DataFrame:
    """``a, b, cosine``: the ``most`` pairs (a before b) of different groups with the largest cosine; ties by a, then b.

    Exact. Rows whose id or group is null, or whose vector is null, zero or holds a null or a number that is not finite,
    take no part; vectors must have one length. Pivots are vectors of smallest seeded hash; only they, a size and a width a cell and the bound reach the driver.
    """
    v = F.transform(vector, lambda e: e.cast("double"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e))
    sound = vectors.where(F.col(id_).isNotNull() & F.col(group).isNotNull()).select(F.col(id_).cast("long").alias("id"), F.col(group).cast("string").alias("kind"), v.alias("v"))
    sound = sound.where(F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e))).withColumn("norm", norm).where((F.col("norm") > 0) & (F.col("norm") < float("inf")))
    sound = cut(sound.select("id", "kind", F.transform("v", lambda e: e / F.col("norm")).alias("v")))
    n = sound.count()
    spark = vectors.sparkSession
    if not n:
        return spark.createDataFrame([], _PAIRS)
    chosen = np.array([r.v for r in sound.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(min(pivots, -(-n // piece))).collect()])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(2).to_pylist(), np.float64)
            if len(x):
                near = x @ chosen.T
                cell = near.argmax(axis=1)
                angle = np.arccos(np.clip(near[np.arange(len(x)), cell], -1, 1))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(cell.astype(np.int32)), pa.array(angle)], ["id", "kind", "v", "cell", "angle"])

    placed = cut(sound.mapInArrow(assign, "id long, kind string, v binary, cell int, angle double"))
    drop(sound)
    cells = {r.cell: (r.n, r.wide) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("wide")).collect()}
    near = chosen @ chosen.T
    rows = min(max(piece, -(-n // BLOCKS)), max(piece, BLOCK_BYTES // (8 * chosen.shape[1])))
    layout = _layout({c: k for c, (k, _) in cells.items()}, near, rows)
    units = spark.createDataFrame([(u, c, p) for u, (c, p, _) in enumerate(layout)], "unit int, cell int, part int")
    parts = spark.createDataFrame([(c, -(-k // rows)) for c, (k, _) in cells.items()], "cell int, parts int")
    held = placed.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64("id", F.lit(11)), F.col("parts")).cast("int"))
    held = cut(held.join(F.broadcast(units), ["cell", "part"]).select("id", "kind", "v", "unit"))
    drop(placed)

    def best(found: DataFrame) -> DataFrame:
        return found.orderBy(F.desc("cosine"), "a", "b").limit(most)

    def within(table: pa.Table) -> pa.Table:
        own = _Units(table)
        return _compare_units(own, ((u, [u]) for u in own.span), -2.0, most, piece, columns)

    own = cut(best(held.groupBy("unit").applyInArrow(within, _PAIRS)))
    low = own.agg(F.when(F.count(F.lit(1)) >= most, F.min("cosine"))).first()[0]
    bound = -2.0 if low is None else low

    between = np.arccos(np.clip(near, -1, 1))
    wide = np.array([cells[c][1] for c, _, _ in layout])
    of = np.array([c for c, _, _ in layout])
    meet = np.triu(np.cos(np.maximum(0.0, between[np.ix_(of, of)] - wide[:, None] - wide[None, :])) >= bound - 1e-9, 1)
    block = np.array([b for _, _, b in layout])
    # A task is a pair of blocks; of each it gets the units that may meet one of the other.
    x, y = np.nonzero(meet)
    task = block[x] * (block[-1] + 1) + block[y]
    sides = np.unique(np.concatenate([np.stack([task, x], 1), np.stack([task, y], 1)]), axis=0)
    sides = cut(spark.createDataFrame(sides.tolist(), "task long, unit int"))
    sent = held.join(F.broadcast(sides), "unit")

    def both(table: pa.Table) -> pa.Table:
        own = _Units(table)
        first, second = divmod(table["task"][0].as_py(), int(block[-1]) + 1)
        meets = ((c, [d for d in own.span if meet[c, d] and block[d] == second]) for c in own.span if block[c] == first)
        return _compare_units(own, meets, bound, most, piece, columns)

    return best(own.unionByName(sent.groupBy("task").applyInArrow(both, _PAIRS)))
