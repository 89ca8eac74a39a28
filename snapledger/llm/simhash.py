"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits, and the bit counts of
the segments make a point in 32 dimensions. The Manhattan distance of two points
is never above the bit distance of their fingerprints, so links within d bits
lie within Manhattan distance d. The dimensions are dealt to d + r slabs; a pair
within distance d agrees in all dimensions of at least r slabs, so it meets in
the grid cell of some r slabs, whatever r. In a cell the Manhattan distance
filters and the bit distance decides. r follows the count of fingerprints: more
slabs make cells of fewer points by chance, but more cells per point.

Only distinct fingerprints enter the grid. A cell hands on a spanning forest of
its links, never all pairs; a cell of more than TILE points is compared tile by
tile in tasks of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import map_batches, written
from snapledger.llm.components import connected_components

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Points of a cell compared in one task.
TILE = 4096
#: Cells of up to this many points are compared by shifting the sorted column.
SHIFTS = 48
SEGMENTS = 32
#: Slabs that a cell's points agree in, at least, and what dealing a point to a
#: cell costs, in comparisons.
AGREE = 3
DEALT = 64
EVEN = np.uint64(0x5555555555555555)
#: Stand-in ids of fingerprints whose documents all have a null id start here.
NO_ID = 1 << 62


def simhash(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a text: each bit is 1 if set in over half of
    the XXH64 values of its word shingles, repeats included."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    if n <= 1:
        return digest(line, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n].tolist()
    hashes = [digest(line[i:j], seed) for i, j in zip(starts, ends[shingle - 1:].tolist(), strict=True)]
    ones = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def popcount_code(points: np.ndarray) -> np.ndarray:
    """The segments' bit counts in unary (00, 01, 11): the bit distance of two
    codes is the Manhattan distance of the count vectors."""
    low, high = points & EVEN, points >> np.uint64(1) & EVEN
    return (low | high) | (low & high) << np.uint64(1)


def agreeing_slabs(points: int, distance: int) -> int:
    """How many slabs a cell's points agree in, for so many distinct fingerprints.

    Two random segments have equal bit counts with probability 3/8, so a point
    meets about points * (3/8)^(segments of r slabs) others by chance in each of
    its cells. The r of the least work per point is taken; every r finds all links.
    """
    def work(r: int) -> float:
        return comb(distance + r, r) * (DEALT + points * 2 ** (log2(3 / 8) * SEGMENTS * r / (distance + r)))

    return min(range(AGREE, SEGMENTS - distance + 1), key=work)


def cell_masks(distance: int, agree: int = AGREE) -> list[np.uint64]:
    """For every ``agree`` of the distance + agree slabs, the bits of their segments."""
    n = distance + agree
    slabs = [sum(3 << 2 * s for s in range(k, SEGMENTS, n)) for k in range(n)]
    return [np.uint64(sum(some)) for some in combinations(slabs, agree)]


def cells_of(batches: Iterator[pa.RecordBatch], distance: int, agree: int = AGREE) -> Iterator[pa.RecordBatch]:
    """``(cell, point, rep)`` of every distinct fingerprint, one row per cell it lies in."""
    masks = cell_masks(distance, agree)
    for b in batches:
        points = np.asarray(b.column(0), np.int64).view(np.uint64)
        codes = popcount_code(points)
        with np.errstate(over="ignore"):
            cells = [((codes & m) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(k)) * np.uint64(0xD6E8FEB86659FD93) for k, m in enumerate(masks)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(cells).view(np.int64)), pa.array(np.tile(points.view(np.int64), len(masks))),
             pa.array(np.tile(np.asarray(b.column(1), np.int64), len(masks)))], ["cell", "point", "rep"])


def near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Which pairs lie within ``distance``: the lower bound first, then the bits."""
    out = np.bitwise_count(popcount_code(a) ^ popcount_code(b)) <= distance
    out[out] = np.bitwise_count(a[out] ^ b[out]) <= distance
    return out


def spanning(points: np.ndarray, reps: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Forest edges of the links among ``points``: breadth first over those not reached yet."""
    codes = popcount_code(points)
    open_ = np.arange(len(points))
    out = []
    while len(open_) > 1:
        queue, open_ = [open_[0]], open_[1:]
        while queue and len(open_):
            q = queue.pop()
            hit = np.flatnonzero(np.bitwise_count(codes[open_] ^ codes[q]) <= distance)
            hit = hit[np.bitwise_count(points[open_[hit]] ^ points[q]) <= distance]
            if len(hit):
                out.append((np.full(len(hit), reps[q]), reps[open_[hit]]))
                queue += open_[hit].tolist()
                open_ = np.delete(open_, hit)
    return out


def links_of_cells(batches: Iterator[pa.RecordBatch], distance: int, tile: int) -> Iterator[pa.RecordBatch]:
    """Links of the cells of one sorted partition, as ``(a, b, null, null)``.

    Points of a cell past its first ``tile`` make it a large one; such a cell's
    points are handed on as ``(point, rep, cell, position)`` instead.
    """
    empty = np.empty(0, np.int64)
    held = [empty, empty, empty]  # rows of the last cell met: it may go on
    passed: tuple[int, int] | None = None  # a large cell and its points so far

    def solve(cell: np.ndarray, point: np.ndarray, rep: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        edges = []
        p = point.view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        sizes = np.diff(np.append(starts, len(cell)))
        for s, n in zip(starts[sizes > SHIFTS].tolist(), sizes[sizes > SHIFTS].tolist(), strict=True):
            edges += spanning(p[s:s + n], rep[s:s + n], distance)
        small = np.repeat(sizes <= SHIFTS, sizes)
        cell, p, rep = cell[small], p[small], rep[small]
        left = np.arange(len(cell))
        for shift in range(1, SHIFTS):
            left = left[left + shift < len(cell)]
            left = left[cell[left] == cell[left + shift]]
            if not len(left):
                break
            hit = left[near(p[left], p[left + shift], distance)]
            if len(hit):
                edges.append((rep[hit], rep[hit + shift]))
        return edges

    def links(edges: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if edges:
            a, b = (np.concatenate(x) for x in zip(*edges, strict=True))
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none, none], COLUMNS)

    def handed(cell: int, point: np.ndarray, rep: np.ndarray, at: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(point), pa.array(rep), pa.array(np.full(len(point), cell)),
                                           pa.array(np.arange(at, at + len(point)))], COLUMNS)

    for b in batches:
        rows = [np.concatenate([h, np.asarray(c, np.int64)]) for h, c in zip(held, b.columns, strict=True)]
        if passed:  # the rest of a large cell
            n = int(np.searchsorted(rows[0], passed[0], side="right"))
            if n:
                yield handed(passed[0], rows[1][:n], rows[2][:n], passed[1])
                passed = (passed[0], passed[1] + n)
            if n == len(rows[0]):
                held = [empty, empty, empty]
                continue
            rows, passed = [r[n:] for r in rows], None
        if not len(rows[0]):
            continue
        last = int(np.searchsorted(rows[0], rows[0][-1]))
        starts = np.flatnonzero(np.concatenate([[True], rows[0][1:last] != rows[0][:max(last - 1, 0)]])) if last else empty
        sizes = np.diff(np.append(starts, last))
        keep = np.ones(last, bool)
        for s, n in zip(starts[sizes > tile].tolist(), sizes[sizes > tile].tolist(), strict=True):
            yield handed(int(rows[0][s]), rows[1][s:s + n], rows[2][s:s + n], 0)
            keep[s:s + n] = False
        if keep.any():
            yield from links(solve(*(r[:last][keep] for r in rows)))
        held = [r[last:] for r in rows]
        if len(held[0]) > tile:
            yield handed(int(held[0][0]), held[1], held[2], 0)
            passed, held = (int(held[0][0]), len(held[0])), [empty, empty, empty]
    if len(held[0]):
        yield from links(solve(*held))


COLUMNS = ["a", "b", "cell", "position"]


def near_links(points: DataFrame, distance: int = DISTANCE, tile: int = TILE, agree: int = AGREE) -> DataFrame:
    """``a, b``: representatives of linked fingerprints, enough to connect every group.

    ``points``: one row per distinct fingerprint, ``point`` (long) and ``rep``;
    ``agree``: see :func:`agreeing_slabs`.
    """
    cells = map_batches(points.select("point", "rep"), lambda it: cells_of(it, distance, agree), "cell long, point long, rep long")
    dealt = cells.repartition("cell").sortWithinPartitions("cell", "point")
    schema = "a long, b long, cell long, position long"
    # Both the links and the large cells' points come from one pass, so it is written.
    first = written(dealt.mapInArrow(lambda it: links_of_cells(it, distance, tile), schema), "simhash-links")
    crowd = first.where("cell IS NOT NULL")
    tiles = crowd.groupBy("cell").agg((F.floor(F.max("position") / tile) + 1).cast("int").alias("n"))
    placed = crowd.join(tiles, "cell").withColumn("i", F.floor(F.col("position") / tile).cast("int"))
    # Tile (lo, hi) compares the blocks lo and hi of a cell; every block meets every other.
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    placed = placed.select("cell", F.least("i", "other").alias("lo"), F.greatest("i", "other").alias("hi"), F.col("a").alias("point"), F.col("b").alias("rep"))

    def solve_tile(pdf):
        import pandas as pd

        edges = spanning(pdf["point"].to_numpy(np.int64).view(np.uint64), pdf["rep"].to_numpy(np.int64), distance)
        a, b = (np.concatenate(x) for x in zip(*edges, strict=True)) if edges else (np.empty(0, np.int64),) * 2
        return pd.DataFrame({"a": a, "b": b})

    more = placed.groupBy("cell", "lo", "hi").applyInPandas(solve_tile, "a long, b long")
    return first.where("cell IS NULL").select("a", "b").union(more)


def simhash_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """``key, fingerprint, component_id`` of every row.

    ``fingerprint``: 16 lowercase hex digits; ``component_id``: the smallest key
    reachable over links of at most ``distance`` differing bits, the own key
    included. Texts without words (null texts too) have fingerprint zero, linked
    like any other. Repeated rows are rows of their own in one component. Rows
    with a null key link others but never name a component; a component without
    any key has a null id. An empty table gives an empty result. Other columns
    are not read.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points = np.array([simhash(t or "", shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(points.view(np.int64))], ["key", "point"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    marked = written(map_batches(rows, mark, "key long, point long"), "simhash")
    points = marked.groupBy("point").agg(F.min("key").alias("rep"))
    points = points.withColumn("rep", F.coalesce("rep", F.lit(NO_ID) + F.shiftrightunsigned("point", 2)))
    # The count only sets the grid's width, so an estimate will do.
    n = marked.agg(F.approx_count_distinct("point")).first()[0]
    groups = connected_components(near_links(points, distance, agree=agreeing_slabs(n, distance)))
    named = points.join(groups, points["rep"] == groups["node"], "left").select("point", F.coalesce("component", "rep").alias("component"))
    out = marked.join(named, "point")
    return out.select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("point")), 16, "0").alias("fingerprint"),
        F.when(F.col("component") < NO_ID, F.col("component")).alias("component_id"))
