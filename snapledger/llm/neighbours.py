"""Embedding near-duplicates by NN-descent.

1. Vectors of a label are dealt to cells by the signs of random projections,
   several times over, and every cell's vectors find their nearest in it: the
   first neighbour lists.
2. NN-descent: the neighbours of a vector, and those that have it as a neighbour,
   are compared with each other; better neighbours replace worse ones. A list
   that is full of links is enlarged instead of losing any. Rounds go on until
   few lists change.
3. Lists that were saturated belong to dense groups. The groups that the lists
   connect are compared as a whole, block by block, which enlarges every list to
   its group: links are counted there with double precision, never listed. Lists
   that are full of links can hide links to other groups; such groups are balls
   around their first vector, and balls that a link can reach across are compared
   as one group.
4. Recall is audited vector by vector: a bounded sample, dealt to labels and to
   classes of link counts, is compared with all vectors of its labels. Below the
   target, the search runs again with more projections and longer lists, joined to
   the lists found so far; labels still short after the last search are compared
   whole, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapledger.functions.skew import salted_join
from snapledger.llm.common import map_batches, written
from snapledger.llm.components import connected_components, forest

LINK = 0.98
#: Lists are kept down to this much below a link, so groups are whole before links are decided.
MARGIN = 0.02
#: List length, and the length that a saturated list may reach.
LIST = 8
ENLARGED = 16
#: Projections (sets of cells), vectors a cell is meant to hold, and most that one task compares at once.
TABLES = 8
CELL = 128
BLOCK = 256
#: Rounds stop when fewer than this share of the list places change.
STILL = 0.002
ROUNDS = 6
#: Sample of the audit, the recall it asks for, and searches at most.
AUDIT = 512
RECALL = 0.995
SEARCHES = 3
SEED = 7


def matrix(raw: pa.Array | list[bytes]) -> np.ndarray:
    """Unit vectors in double precision from their float64 bytes."""
    rows = raw.to_pylist() if isinstance(raw, pa.Array) else list(raw)
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)


def unit_vectors(vectors: DataFrame, key: str, label: str, embedding: str) -> DataFrame:
    """``rid, key, label, vec``: rows numbered once and for all; ``vec`` is the
    unit vector's bytes, null for vectors that link with nothing."""

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[bytes | None] = []
            for group, v in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                x = np.array(v, np.float64) if group is not None and v and None not in v else np.empty(0)
                big = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
                x = x / big if big > 0 else x  # neither overflow nor underflow in the norm
                out.append((x / np.sqrt(x @ x)).astype("<f8").tobytes() if big > 0 else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["key", "label", "vec"])

    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(label).cast("string").alias("label"),
                          F.col(embedding).cast("array<double>").alias("embedding"))
    numbered = map_batches(rows, unit, "key long, label string, vec binary").withColumn("rid", F.monotonically_increasing_id())
    # Vectors of different lengths can't be compared: the length is part of the label.
    numbered = numbered.withColumn("label", F.when(F.col("vec").isNotNull(), F.concat_ws(":", F.octet_length("vec"), "label")))
    return written(numbered, "unit-vectors")


def nearest(rids: np.ndarray, vecs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vector, neighbour, cosine) of each vector's ``k`` nearest among the others."""
    n = len(rids)
    k = min(k, n - 1)
    if k < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    sims = vecs @ vecs.T
    np.fill_diagonal(sims, -2.0)
    best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return np.repeat(rids, k), rids[best.ravel()], np.take_along_axis(sims, best, 1).ravel()


def sorted_groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, list]]:
    """Slices of whole groups of a partition sorted by its first ``width`` columns:
    (start of each group, columns as lists)."""
    held: list[list] | None = None
    for b in batches:
        cols = [c.to_pylist() for c in b.columns]
        if held:
            cols = [h + c for h, c in zip(held, cols, strict=True)]
        n = len(cols[0])
        last = n
        while last and all(c[last - 1] == c[n - 1] for c in cols[:width]):
            last -= 1
        held = [c[last:] for c in cols]
        if last:
            yield starts_of(cols, last, width), [c[:last] for c in cols]
    if held and held[0]:
        yield starts_of(held, len(held[0]), width), held


def starts_of(cols: list[list], n: int, width: int) -> np.ndarray:
    new = [i == 0 or any(c[i] != c[i - 1] for c in cols[:width]) for i in range(n)]
    return np.flatnonzero(new)


def list_rows(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    if parts:
        u, v, s = (np.concatenate(x) for x in zip(*parts, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(s.astype(np.float32))], ["u", "v", "sim"])


LISTS = "u long, v long, sim float"


def first_lists(vectors: DataFrame, tables: int, k: int, seed: int) -> DataFrame:
    """Neighbour lists from the cells of random projections."""
    sizes = vectors.groupBy("label").agg(F.count("*").alias("n"))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / CELL))).cast("int")
    placed = vectors.join(sizes.select("label", bits.alias("bits")), "label").select("rid", "label", "bits", "vec")

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            lengths = np.array([len(x) for x in b.column(3).to_pylist()]) if b.num_rows else np.empty(0, int)
            for length in np.unique(lengths):
                part = b.take(pa.array(np.flatnonzero(lengths == length)))
                vecs, want = matrix(part.column(3)), np.asarray(part.column(2), np.int64)
                if length not in planes:
                    planes[length] = np.random.default_rng(seed).standard_normal((vecs.shape[1], tables * 30))
                signs = (vecs @ planes[length] > 0).reshape(len(vecs), tables, 30)
                used = np.arange(30) < np.minimum(want, 30)[:, None]
                codes = (signs & used[:, None, :]) @ (1 << np.arange(30, dtype=np.int64))
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [part.column(1), pa.array(codes[:, t] * tables + t), part.column(0), part.column(3)], ["label", "cell", "rid", "vec"])

    dealt = map_batches(placed, cells, "label string, cell long, rid long, vec binary")
    # A cell of many vectors (a dense group) is dealt to parts of about BLOCK vectors, by chance.
    crowded = dealt.groupBy("label", "cell").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    parts = dealt.join(crowded, ["label", "cell"], "left").withColumn(
        "part", F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("rid", "cell", F.lit(seed)), F.ceil(F.col("n") / BLOCK) )))
    ready = parts.select("label", "cell", "part", "rid", "vec").repartition("label", "cell", "part").sortWithinPartitions("label", "cell", "part")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, (_, _, _, rids, vecs) in sorted_groups(batches, 3):
            ends = np.append(starts[1:], len(rids))
            yield from list_rows([nearest(np.array(rids[s:e], np.int64), matrix(vecs[s:e]), k)
                                  for s, e in zip(starts.tolist(), ends.tolist(), strict=True) if e - s > 1])

    return map_batches(ready, search, LISTS)


def best_lists(rows: DataFrame, k: int, enlarged: int, group: float) -> DataFrame:
    """Each vector's ``k`` best neighbours; up to ``enlarged`` while they are links."""
    once = rows.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v")))
    return ranked.where((F.col("rank") <= k) | ((F.col("rank") <= enlarged) & (F.col("sim") >= group))).select("u", "v", "sim", "rank")


def descend(lists: DataFrame, vectors: DataFrame, k: int, seed: int) -> DataFrame:
    """One NN-descent join: the neighbours of each vector compared with one another.

    A vector's own neighbours all take part; of those that have it as a neighbour,
    ``k`` chosen anew in every round (the group blocks and the audit stand for the rest).
    """
    back = lists.select(F.col("v").alias("at"), F.col("u").alias("rid"))
    chosen = back.withColumn("rank", F.row_number().over(Window.partitionBy("at").orderBy(F.xxhash64("rid", F.lit(seed))))).where(F.col("rank") <= k)
    around = lists.where(F.col("rank") <= k).select(F.col("u").alias("at"), F.col("v").alias("rid")).union(chosen.select("at", "rid")).distinct()
    worst = lists.where(F.col("rank") <= k).groupBy("u").agg(F.min("sim").alias("worst"), F.count("*").alias("n"))
    worst = worst.select(F.col("u").alias("rid"), F.when(F.col("n") < k, F.lit(-2.0)).otherwise(F.col("worst")).alias("worst"))
    known = vectors.select("rid", "vec").join(worst, "rid", "left")
    ready = around.join(known, "rid").select("at", "rid", "worst", "vec").repartition("at").sortWithinPartitions("at")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, (_, rids, worst, vecs) in sorted_groups(batches, 1):
            ends, out = np.append(starts[1:], len(rids)), []
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                if e - s < 2:
                    continue
                x, r = matrix(vecs[s:e]), np.array(rids[s:e], np.int64)
                least = np.array([-2.0 if w is None else w for w in worst[s:e]])
                sims = x @ x.T
                np.fill_diagonal(sims, -3.0)
                i, j = np.nonzero(sims > least[:, None] + 1e-6)
                if len(i):
                    out.append((r[i], r[j], sims[i, j]))
            yield from list_rows(out)

    return map_batches(ready, compare, LISTS)


def search_lists(vectors: DataFrame, seed: int, tables: int, k: int, enlarged: int, group: float, start: DataFrame | None) -> DataFrame:
    first = first_lists(vectors, tables, k, seed)
    if start is not None:
        first = first.union(start.select("u", "v", "sim"))
    lists = written(best_lists(first, k, enlarged, group), "lists")
    for turn in range(ROUNDS):
        new = descend(lists, vectors, k, seed + turn)
        after = written(best_lists(lists.select("u", "v", "sim").union(new), k, enlarged, group), "lists")
        places, same = after.count(), after.join(lists, ["u", "v"], "left_semi").count()
        lists = after
        if places - same <= STILL * places:
            break
    return lists


def angle(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def whole_groups(vectors: DataFrame, lists: DataFrame, k: int, link: float, group: float) -> DataFrame:
    """``node, component``: groups that hold every link of a vector whose list is full.

    The groups are those that the lists connect. Where a list holds ``k`` vectors
    above the group bound, it may have no place for links to another group: such a
    group is a ball around its first vector, with the angle of its farthest one as
    radius, and balls nearer to each other than both radii and a link's angle are
    one group. All balls of a label are compared, block by block.
    """
    edges = lists.where(F.col("sim") >= group - 1e-4).select(F.col("u").alias("a"), F.col("v").alias("b"))
    groups = written(connected_components(edges), "groups")
    full = lists.where((F.col("rank") == k) & (F.col("sim") >= group - 1e-4)).select(F.col("u").alias("node"))
    crowded = written(groups.join(full, "node").select("component").distinct(), "full-groups")
    inside = groups.join(crowded, "component")
    members = vectors.select("rid", "vec").join(inside, F.col("rid") == F.col("node")).select("component", "rid", "vec")
    centres = vectors.join(crowded, F.col("rid") == F.col("component")).select("component", "label", F.col("vec").alias("centre"))

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cosines = [np.einsum("ij,ij->i", matrix([x]), matrix([y])) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            radii = angle(np.concatenate(cosines)) if cosines else np.empty(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(radii, pa.float64())], ["component", "radius"])

    pairs = salted_join(members, centres.select("component", "centre"), ["component"], key_source=inside)
    radii = map_batches(pairs.select("component", "vec", "centre"), far, "component long, radius double").groupBy("component").agg(F.max("radius").alias("radius"))
    balls = written(centres.join(radii, "component"), "balls")
    sizes = balls.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    placed = balls.join(sizes, "label").withColumn("part", F.pmod(F.xxhash64("component"), F.col("parts")).cast("int"))
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "label", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "component", "radius", "centre")
    ready = tiles.repartition("label", "lo", "hi").sortWithinPartitions("label", "lo", "hi", "component")
    reach = float(angle(np.array(link))) + 1e-6

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, (_, _, _, names, radii, centres) in sorted_groups(batches, 3):
            ends = np.append(starts[1:], len(names))
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                r, x = np.array(radii[s:e]), matrix(centres[s:e])
                i, j = np.nonzero(np.triu(angle(x @ x.T) <= r[:, None] + r[None, :] + reach, 1))
                if len(i):
                    own = np.array(names[s:e], np.int64)
                    a, b = forest(own[i], own[j])
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    across = map_batches(ready, meet, "a long, b long")
    return connected_components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(across))


def group_links(vectors: DataFrame, groups: DataFrame, link: float) -> tuple[DataFrame, DataFrame]:
    """Links counted inside groups (``node, component``): ``rid, n_links`` and forest
    edges of the links."""
    members = vectors.select("rid", "vec").join(groups, F.col("rid") == F.col("node")).select("component", "rid", "vec")
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    placed = members.join(sizes, "component").withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int"))
    # Tile (lo, hi) compares two parts of a group; each part meets every part, itself included.
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "component", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "rid", "vec")
    ready = tiles.repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi", "rid")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for starts, (_, lows, highs, parts, rids, vecs) in sorted_groups(batches, 3):
            ends = np.append(starts[1:], len(rids))
            out = []
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                r, p, x = np.array(rids[s:e], np.int64), np.array(parts[s:e]), matrix(vecs[s:e])
                near = x @ x.T >= link
                np.fill_diagonal(near, False)
                if lows[s] != highs[s]:
                    near &= p[:, None] != p[None, :]  # pairs inside a part belong to its own tile
                i, j = np.nonzero(np.triu(near))
                a, b = forest(r[i], r[j]) if len(i) else (np.empty(0, np.int64),) * 2
                out.append((r, near.sum(axis=1), np.full(len(r), -1)))
                out.append((a, np.zeros(len(a), np.int64), b))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)], ["rid", "links", "to"])

    counted = written(map_batches(ready, count, "rid long, links long, to long"), "group-links")
    links = counted.where("to = -1").groupBy("rid").agg(F.sum("links").alias("n_links"))
    return links, counted.where("to <> -1").select(F.col("rid").alias("a"), F.col("to").alias("b"))


def audited(vectors: DataFrame, links: DataFrame, link: float, sample: int) -> tuple[float, list[str]]:
    """Recall of a sample compared with all vectors, and the labels in which a link is missing.

    At most ``sample`` vectors are handed to the tasks, chosen by hash and in turn
    from each label's vectors without links, with one, with two or three, and so
    on. A vector's recall is the share of its links that were found; the result is
    the mean of the worst label or class.
    """
    rows = vectors.join(links, "rid", "left").select("rid", "label", "vec", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    rows = rows.withColumn("size", F.floor(F.log2(F.col("n_links") + 1)))
    turn = F.row_number().over(Window.partitionBy("label", "size").orderBy(F.xxhash64("rid"), "rid"))
    asked = rows.withColumn("turn", turn).where(F.col("turn") <= sample).orderBy("turn", F.xxhash64("rid"), "rid").limit(sample).collect()
    queries: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for name in {r["label"] for r in asked}:
        own = [r for r in asked if r["label"] == name]
        queries[name] = np.array([r["rid"] for r in own]), matrix([bytes(r["vec"]) for r in own])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels = np.array(b.column(1).to_pylist(), object)
            for name in set(labels.tolist()) & set(queries):
                at = np.flatnonzero(labels == name)
                near = matrix(b.column(2).take(pa.array(at))) @ queries[name][1].T >= link
                near &= np.asarray(b.column(0), np.int64)[at][:, None] != queries[name][0][None, :]
                n = near.sum(axis=0)
                met = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(queries[name][0][met]), pa.array(n[met])], ["rid", "n"])

    true = map_batches(vectors.select("rid", "label", "vec"), compare, "rid long, n long").groupBy("rid").agg(F.sum("n").alias("n"))
    every = {r["rid"]: r["n"] for r in true.collect()}
    shares: dict[tuple, list[float]] = {}
    for r in asked:
        n = every.get(r["rid"], 0)
        for kind in (("label", r["label"]), ("links", n.bit_length())):
            shares.setdefault(kind, []).append(min(1.0, r["n_links"] / n) if n else 1.0)
    short = sorted({r["label"] for r in asked if r["n_links"] < every.get(r["rid"], 0)})
    return min((float(np.mean(x)) for x in shares.values()), default=1.0), short


def vector_links(
    vectors: DataFrame, key: str = "vec_id", label: str = "label", embedding: str = "embedding", link: float = LINK,
    tables: int = TABLES, k: int = LIST, recall: float = RECALL,
) -> DataFrame:
    """``key, n_links, component_id, kept``: one row per input row.

    Rows link when their labels are equal and not null and their cosine in
    double precision is ``link`` or more. Vectors that are null, empty or zero,
    or that hold null or non-finite components, and vectors of different lengths
    link with nothing. Repeated rows are rows of their own (and link). Components
    take the smallest key reachable; a row with a null key links, names no
    component, and is not kept unless it stands alone. An empty table gives an
    empty result. Other columns are not read.
    """
    rows = unit_vectors(vectors, key, label, embedding)
    known = rows.where("vec IS NOT NULL").select("rid", "label", "vec")
    group = link - MARGIN
    lists: DataFrame | None = None
    for turn in range(SEARCHES):
        more = 2**turn
        lists = search_lists(known, SEED + 100 * turn, tables * more, k * more, ENLARGED * more, group, lists)
        groups = whole_groups(known, lists, k * more, link, group)
        links, edges = group_links(known, groups, link)
        found, short = audited(known, links, link, AUDIT)
        if found >= recall:
            break
    else:
        labels = known.where(F.col("label").isin(short))
        first = labels.groupBy("label").agg(F.min("rid").alias("component"))
        whole = labels.join(F.broadcast(first), "label").select(F.col("rid").alias("node"), "component")
        links, edges = group_links(known, groups.join(whole, "node", "left_anti").union(whole), link)
    groups = connected_components(edges)
    marked = rows.select("rid", "key").join(links, "rid", "left").join(groups, F.col("rid") == F.col("node"), "left")
    marked = written(marked.select("key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "rid").alias("component")), "vector-links")
    names = marked.groupBy("component").agg(F.min("key").alias("component_id"))
    out = marked.join(names, "component")
    return out.select(F.col("key").alias(key), "n_links", "component_id",
                      F.coalesce(F.col("key") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
