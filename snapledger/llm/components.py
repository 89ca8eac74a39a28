"""Connected components of an edge table by large-star / small-star rounds.

Every round is joins and partially aggregated minima over the edges, so a node
with very many edges is reduced in the map tasks; the join on such a node is
dealt to parts. Nothing but two numbers per round reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.functions.skew import salted_join
from snapledger.llm.common import written


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its group) of the groups that edges a-b form."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[:len(a)], where[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of each batch replaced by a star forest of the same groups."""
    for b in batches:
        if b.num_rows:
            x, y = forest(np.asarray(b.column(0), np.int64), np.asarray(b.column(1), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node that has
    an edge to another node. Loops and repeated edges don't matter; rows with a
    null end are left out; no edges give an empty result.
    """
    pairs = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a != b")
    # a > b from here on
    pairs = written(pairs.mapInArrow(contracted, "a long, b long").distinct(), "edges")
    seen: tuple | None = None
    while True:
        state = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            break
        seen = state
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = salted_join(both.where("v > u"), low, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        pairs = written(small.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
    # At the fixed point every edge is node -> smallest node of its component.
    members = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
