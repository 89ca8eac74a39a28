"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source is a stream of words in shards of bounded size, and every shard is
cut into blocks of about equal words. The house of blocks is dealt to sources,
then to each source's shards, by highest quotients (population divided by 1, 3,
5, ...), which gives every shard an integer quota. A quota of q blocks in a
shard of n blocks takes every block q // n times, and q % n more blocks in
seeded order once more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import map_batches, written

#: Words in a block, words and rows that one shard is meant to hold.
BLOCK_WORDS = 64
SHARD_WORDS = 1 << 17
SHARD_ROWS = 1 << 14
#: Times a document may be repeated.
MOST = 3
SEED = 20
WEIGHTS = (5.0, 2.0, 1.0)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sainte_lague(population: np.ndarray, seats: int, most: np.ndarray | None = None) -> np.ndarray:
    """Seats per party by highest quotients; ties go to the earlier party.

    ``most`` bounds the seats of each party. The divisor is found by bisection
    and the seats left at it are dealt by quotient, which equals dealing all
    seats one by one.
    """
    p = np.asarray(population, np.float64)
    top = np.full(len(p), seats, np.int64) if most is None else np.asarray(most, np.int64)
    top = np.where(p > 0, top, 0)
    seats = min(int(seats), int(top.sum()))
    if seats <= 0:
        return np.zeros(len(p), np.int64)

    def dealt(divisor: float) -> np.ndarray:
        return np.minimum(np.floor(np.minimum(p / divisor, 2.0**52) + 0.5).astype(np.int64), top)

    lo, hi = 0.0, 2.0 * float(p.max()) + 1.0  # too many seats (or all), too few
    for _ in range(200):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        lo, hi = (mid, hi) if dealt(mid).sum() > seats else (lo, mid)
    out = dealt(hi)
    while (left := seats - int(out.sum())) > 0:
        quotient = np.where(out < top, p / (2.0 * out + 1.0), -1.0)
        out[np.lexsort((np.arange(len(p)), -quotient))[:left]] += 1
        out = np.minimum(out, top)
    return out


def targets(sizes: Sequence[float], weights: Sequence[float], most: float = MOST) -> np.ndarray:
    """Shares of the total size by weight; what is above ``most`` times a
    source's size is shared again by weight until none is above."""
    size, w = np.asarray(sizes, np.float64), np.asarray(weights, np.float64)
    out, open_ = np.zeros(len(size)), size > 0
    left = float(size.sum())
    while open_.any():
        share = left * w / w[open_].sum()
        above = open_ & (share > most * size)
        if not above.any():
            out[open_] = share[open_]
            break
        out[above] = most * size[above]
        left -= float(out[above].sum())
        open_ &= ~above
    return out


def chosen_blocks(words: int, blocks: int, quota: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions of a shard's block edges, and 1 for the blocks taken once more."""
    cuts = np.arange(blocks + 1, dtype=np.int64) * words // blocks
    order = np.random.default_rng(seed).permutation(blocks)
    chosen = np.zeros(blocks, np.int64)
    chosen[order[:quota % blocks]] = 1
    return cuts, chosen


def chosen_spans(sizes: np.ndarray, blocks: int, quota: int, seed: int) -> list[list[int]]:
    """For each document of a shard the word ranges of the blocks taken once more: [from, to, from, to, ...]."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1] or not blocks:
        return [[] for _ in sizes]
    cuts, chosen = chosen_blocks(int(ends[-1]), blocks, quota, seed)
    edge = np.diff(np.concatenate([[0], chosen, [0]]))
    lo, hi = cuts[np.flatnonzero(edge == 1)], cuts[np.flatnonzero(edge == -1)]
    out = []
    for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        i, j = np.searchsorted(hi, a, side="right"), np.searchsorted(lo, b)
        part = np.stack([np.maximum(lo[i:j], a), np.minimum(hi[i:j], b)], 1) - a if b > a else np.empty((0, 2), np.int64)
        out.append(part.ravel().tolist())
    return out


def taken_words(sizes: np.ndarray, blocks: int, quota: int, seed: int) -> np.ndarray:
    """Words taken of each document of one shard, in the shard's order."""
    ends = np.cumsum(sizes)
    words = int(ends[-1]) if len(ends) else 0
    if not words or not blocks:
        return np.zeros(len(sizes), np.int64)
    cuts, chosen = chosen_blocks(words, blocks, quota, seed)
    before = np.concatenate([[0], np.cumsum(chosen * np.diff(cuts))])  # chosen words before each cut

    def upto(x: np.ndarray) -> np.ndarray:
        b = np.minimum(np.searchsorted(cuts, x, side="right") - 1, blocks - 1)
        return before[b] + chosen[b] * (x - cuts[b])

    return quota // blocks * sizes + upto(ends) - upto(ends - sizes)


def word_sizes(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """``key, source, size``: words are runs without ASCII white space."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = [len(t.encode().split()) if t else 0 for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int64())], ["key", "source", "size"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(source).cast("string").alias("source"),
                       F.col(text).cast("string").alias("text"))
    return map_batches(rows, count, "key long, source string, size long")


def mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: Sequence[float] = WEIGHTS,
    seed: int = SEED, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, with_spans: bool = False,
) -> DataFrame:
    """Words to take of every document so that sources reach their targets.

    Sources in code-point order (null, a source of its own, last) get
    ``weights`` in turn. Returns ``key, size, source_size, target, taken``, one
    row per input row; ``with_spans`` adds how often the whole text is taken
    (``times``) and the word ranges taken once more (``spans``: from, to, ...). A null text has size 0 and takes 0; repeated rows are
    rows of their own; a null key is kept; an empty table gives an empty result;
    other columns are not read. The result depends on the rows alone, so reruns
    agree.

    Only ids and sizes are shuffled. The table of sources has one row per
    source, the table of shards one row per ``shard_words`` words.
    """
    sizes = written(word_sizes(docs, key, source, text), "mix-sizes")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    named = totals.withColumn("shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("rows") / SHARD_ROWS)).cast("long"))
    named = named.withColumn("name", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("rows")
    placed = (
        sizes.withColumn("name", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
        .join(named.drop("source"), "name")
        .withColumn("shard", F.pmod(F.xxhash64("key", "size", F.lit(seed)), F.col("shards")))
        .select("name", "shard", F.col("key").isNull().alias("nokey"), F.coalesce("key", F.lit(0)).alias("key"), "size")
    )
    shards = placed.groupBy("name", "shard").agg(F.sum("size").alias("words")).withColumn(
        "blocks", F.ceil(F.col("words") / block_words).cast("long"))
    per_source = shards.groupBy("name").agg(F.sum("blocks").alias("blocks")).join(named, "name")

    def deal_sources(pdf: pd.DataFrame) -> pd.DataFrame:
        """One row per source: targets, and quotas in blocks."""
        known = pdf["source"].notna()
        pdf = pd.concat([pdf[known].iloc[np.argsort([s.encode() for s in pdf.loc[known, "source"]], kind="stable")], pdf[~known]])
        size = pdf["source_size"].to_numpy(np.float64)
        target = targets(size, [weights[i % len(weights)] for i in range(len(pdf))])
        blocks = pdf["blocks"].to_numpy(np.int64)
        population = np.divide(target, size, out=np.zeros(len(size)), where=size > 0) * blocks
        quota = sainte_lague(population, round(population.sum()), MOST * blocks)
        return pd.DataFrame({"name": pdf["name"], "source_size": pdf["source_size"], "target": target, "source_quota": quota})

    dealt = per_source.groupBy(F.lit(0).alias("all")).applyInPandas(
        lambda pdf: deal_sources(pdf), "name string, source_size long, target double, source_quota long")

    def deal_shards(pdf: pd.DataFrame) -> pd.DataFrame:
        """One row per shard of a source: its quota."""
        pdf = pdf.sort_values("shard")
        blocks = pdf["blocks"].to_numpy(np.int64)
        return pdf.assign(quota=sainte_lague(blocks, int(pdf["source_quota"].iloc[0]), MOST * blocks)).drop(columns="source_quota")

    quotas = shards.drop("words").join(dealt, "name").groupBy("name").applyInPandas(
        deal_shards, "name string, shard long, blocks long, source_size long, target double, quota long")

    def take(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["nokey", "key", "size"])
        first = pdf.iloc[0]
        own = int.from_bytes(str((seed, first["name"], int(first["shard"]))).encode(), "little")
        sizes, blocks, quota = pdf["size"].to_numpy(np.int64), int(first["blocks"]), int(first["quota"])
        out = pdf[["nokey", "key", "size", "source_size", "target"]].assign(taken=taken_words(sizes, blocks, quota, own))
        if with_spans:
            out = out.assign(times=quota // blocks if blocks else 0, spans=chosen_spans(sizes, blocks, quota, own))
        return out

    out = placed.join(quotas, ["name", "shard"]).groupBy("name", "shard").applyInPandas(
        take, "nokey boolean, key long, size long, source_size long, target double, taken long" + (", times long, spans array<long>" if with_spans else ""))
    return out.select(F.when(~F.col("nokey"), F.col("key")).alias(key), *out.columns[2:])


def words_cut(text: Column, spans: Column) -> Column:
    """The word ranges of a text, each as it stands in the text, joined by newlines."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, ranges: pd.Series) -> pd.Series:
        out = []
        for t, r in zip(texts, ranges, strict=True):
            if t is None or r is None or not len(r):
                out.append("")
                continue
            at = [m.span() for m in WORD.finditer(t)]
            out.append("\n".join(t[at[a][0]:at[b - 1][1]] for a, b in zip(r[::2], r[1::2], strict=True)))
        return pd.Series(out, dtype=object)

    return cut(text.cast("string"), spans)
