"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text is a set of hashed features (words, word beginnings, and how its words
are shaped and repeated). One weight per feature gives the text a position on a
line; ascending thresholds cut the line into grades:

    P(grade <= k) = sigmoid(threshold[k] - position)

so the weights are shared by all grades. The expected grade orders texts, and the
tail probability P(grade >= top) selects them.

The model is fitted on a bounded sample of rated texts (``SAMPLE`` rows, by a hash
of the key): of the features in it, those whose grades differ from the sample's
beyond chance (a score of ``SCORE`` standard deviations) get weights.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import kept, map_batches

#: Rated texts that the model is fitted on, at most.
SAMPLE = 6000
#: Texts that a feature must be in, and its score against chance.
LEAST_TEXTS = 3
SCORE = 4.0
#: Penalty on squared weights, steps and step size of the fit.
PENALTY = 0.02
STEPS = 400
RATE = 0.1
KEEP_WORDS = 200_000
#: Signs of the longest word that is a feature as a whole and kept per worker; longer
#: ones (text without spaces, say) are read in pieces of so many signs, one at each sign.
LONG_WORD = 40
PIECE = 4

OTHER = re.compile(r"[\W_]+")
RUNS = re.compile(r"(.)\1+")


def hashed(s: str) -> int:
    return xxhash.xxh32_intdigest(s.encode("utf-8", "surrogatepass"))


def shape(word: str) -> str:
    """Letters as a or A, digits as 0, other signs as they are, runs as one, over the whole word."""
    s = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return RUNS.sub(r"\1", s)


class Words(dict):
    """Shape and features of each word as written; of the features those in ``only``, if given."""

    def __init__(self, only: dict[int, float] | None = None) -> None:
        super().__init__()
        self.only = only

    def __missing__(self, word: str) -> tuple[str, tuple[int, ...]]:
        core = OTHER.sub("", word.lower())
        if len(core) > LONG_WORD:
            names = {f"p:{core[i:i + PIECE]}" for i in range(len(core) - PIECE + 1)}
        else:
            names = [f"w:{core}"] if core else []
            names += [f"b{n}:{core[:n]}" for n in (4, 5) if len(core) > n]
        own = tuple(map(hashed, names))
        out = (shape(word), own if self.only is None else tuple(f for f in own if f in self.only))
        if len(word) > LONG_WORD:
            return out
        if len(self) >= KEEP_WORDS:
            self.clear()
        self[word] = out
        return out


def features(text: str, words: Words | None = None) -> set[int]:
    """Hashed features of a whole text; those that ``words`` knows, if given."""
    words = kept("words", Words) if words is None else words
    counts = Counter(text.split())
    n = sum(counts.values())
    out: set[int] = set()
    shapes: Counter[str] = Counter()
    for word, k in counts.items():
        kind, own = words[word]
        shapes[kind] += k
        if own:
            out.update(own)
    # A share of tenths has the features of all smaller shares too.
    names = [f"s:{kind}:{i}" for kind, k in shapes.items() if k > 2 for i in range(10 * k // n + 1)]
    names += [f"n:{n.bit_length()}"]
    if n:
        names += [f"d:{n.bit_length()}:{10 * len(counts) // n}", f"t:{10 * max(counts.values()) // n}"]
    out.update(map(hashed, names))
    return out if words.only is None else out & words.only.keys()


@dataclass
class OrdinalModel:
    """Weights by hashed feature, and one threshold below each grade but the first."""

    weights: dict[int, float]
    thresholds: tuple[float, ...]

    @cached_property
    def token(self) -> int:
        return hash(tuple(self.weights.items()))

    def position(self, text: str) -> float:
        words = kept(f"words {self.token}", lambda: Words(self.weights))
        return math.fsum(self.weights[f] for f in features(text, words))

    def tails(self, text: str) -> list[float]:
        """P(grade >= k) for k = 1, 2, ..."""
        x = self.position(text)
        return [1.0 / (1.0 + math.exp(min(60.0, max(-60.0, t - x)))) for t in self.thresholds]


def packed(text: str) -> np.ndarray:
    """The features of a text in ascending order, four bytes each."""
    found = features(text)
    return np.sort(np.fromiter(found, np.uint32, len(found)))


def fit(texts: list[np.ndarray], grades: list[int], top: int) -> OrdinalModel:
    """Fit on the texts' features and their grades 0..top."""
    y = np.array(grades, np.int64)
    if len(set(grades)) < 2:
        low = 20.0 if not grades or grades[0] < top else -20.0
        return OrdinalModel({}, tuple([-20.0 if not grades else low] * top))
    ids, where = np.unique(np.concatenate(texts), return_inverse=True)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    df = np.bincount(where)
    keep = np.zeros(len(ids), bool)
    for g in range(top + 1):
        p = float((y == g).mean())
        if 0 < p < 1:
            hits = np.bincount(where, weights=(y[row] == g))
            keep |= np.abs(hits - p * df) >= SCORE * np.sqrt(df * p * (1 - p))
    keep &= df >= LEAST_TEXTS
    number = np.cumsum(keep) - 1
    used = keep[where]
    col, row, m = number[where[used]], row[used], int(keep.sum())

    w = np.zeros(m)
    share = np.clip([(y >= k).mean() for k in range(1, top + 1)], 1e-3, 1 - 1e-3)
    cuts = -np.log(share / (1 - share))  # P(y >= k) = sigmoid(position - cut)
    cuts = np.maximum.accumulate(cuts + 1e-3 * np.arange(top))
    theta = np.concatenate([w, cuts[:1], np.log(np.expm1(np.maximum(np.diff(cuts), 1e-3)))])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w = theta[:m]
        gaps = np.log1p(np.exp(theta[m + 1:]))  # thresholds ascend
        cut = theta[m] + np.concatenate([[0.0], np.cumsum(gaps)])
        x = np.bincount(row, weights=w[col], minlength=len(y))
        # P(y) = tail(y) - tail(y + 1)
        tail = 1 / (1 + np.exp(np.clip(cut[None, :] - x[:, None], -50, 50)))
        full = np.concatenate([np.ones((len(y), 1)), tail, np.zeros((len(y), 1))], axis=1)
        slope = full * (1 - full)
        at = np.arange(len(y))
        p = np.maximum(full[at, y] - full[at, y + 1], 1e-12)
        gx = -(slope[at, y] - slope[at, y + 1]) / p
        gcut = np.zeros((len(y), top + 2))
        gcut[at, y] += slope[at, y] / p
        gcut[at, y + 1] -= slope[at, y + 1] / p
        gc = gcut.sum(axis=0)[1:-1]
        gw = np.bincount(col, weights=gx[row], minlength=m) / len(y) + PENALTY * w / len(y) ** 0.5
        ggap = np.array([gc[k:].sum() for k in range(1, top)]) / len(y) / (1 + np.exp(-theta[m + 1:]))
        grad = np.concatenate([gw, [gc.sum() / len(y)], ggap])
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        theta = theta - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    gaps = np.log1p(np.exp(theta[m + 1:]))
    cut = theta[m] + np.concatenate([[0.0], np.cumsum(gaps)])
    return OrdinalModel(dict(zip(ids[keep].tolist(), theta[:m].tolist(), strict=True)), tuple(cut.tolist()))


def ratings(labels: DataFrame, key: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """``key, grade``: 0 toxic, 1 poor, 2 good; the worst where a key is rated twice.
    Rows without a key, or without a rating that tells the grade, are left out."""
    grade = F.when(F.col(toxic) > 0, 0).when(F.col(quality) <= 0, 1).when(F.col(quality) > 0, 2)
    return labels.select(F.col(key).cast("long").alias("key"), grade.alias("grade")).na.drop().groupBy("key").agg(F.min("grade").alias("grade"))


def fit_on(docs: DataFrame, rated: DataFrame, key: str = "doc_id", text: str = "text", top: int = 2, sample: int = SAMPLE) -> OrdinalModel:
    """Fit on one text of each of at most ``sample`` ratings (``key, grade``), by a hash of the key.

    Of the texts of a repeated key, the one with the least hash.
    """
    chosen = rated.orderBy(F.xxhash64("key"), "key").limit(sample)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    # The sample has at most ``sample`` rows of two numbers.
    met = rows.join(F.broadcast(chosen), "key").withColumn("text", F.coalesce("text", F.lit("")))
    own = met.groupBy("key", "grade").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("one")).select("key", "grade", "one.text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [packed(t or "").astype("<u4").tobytes() for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.binary())], ["key", "grade", "features"])

    got = sorted((r["key"], r["grade"], bytes(r["features"])) for r in map_batches(own, extract, "key long, grade int, features binary").collect())
    return fit([np.frombuffer(f, "<u4") for _, _, f in got], [g for _, g, _ in got], top)


def graded(text: Column, model: OrdinalModel) -> Column:
    """``struct(expected, tail, toxic)`` of a text column: the expected grade, the
    probability of the top grade and that of the lowest."""

    @F.pandas_udf("expected double, tail double, lowest double")
    def score(texts: pd.Series) -> pd.DataFrame:
        rows = [model.tails(t or "") for t in texts]
        return pd.DataFrame({"expected": [math.fsum(r) for r in rows], "tail": [r[-1] for r in rows], "lowest": [1 - r[0] for r in rows]})

    return score(text.cast("string"))


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``key, expected_grade, p_good, p_toxic, keep`` of every whole text; no shuffle of texts.

    Texts whose probability of the top grade is below ``least`` are rejected. A
    null text counts as empty; null keys and repeated rows are kept; without
    ratings of two grades every text is kept, or none if all are rated below the
    top; an empty table gives an empty result; other columns are not read.
    """
    model = fit_on(docs, ratings(labels), key, text)
    told = docs.select(F.col(key), graded(F.col(text), model).alias("g"))
    return told.select(F.col(key).cast("long").alias(key), F.col("g.expected").alias("expected_grade"), F.col("g.tail").alias("p_good"),
                       F.col("g.lowest").alias("p_toxic"), (F.col("g.tail") >= least).alias("keep"))
