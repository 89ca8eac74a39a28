"""Periodic runs in whole texts: seed-and-extend on the diagonals of equal k-grams.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and at least ``max(least, copies * q)`` words that no neighbouring
word extends with that period. Along such a run the text equals itself shifted
by q over at least ``max(least, copies * q) - q`` words, so every run holds equal
k-grams at lag q. Lags are taken in classes [2^j, 2^(j+1)); k is the smallest
such overlap in the class, which is never below q. Then the next occurrence of a
run's k-gram after the one at word i stands at i + q exactly (a nearer one would
make a smaller period), so pairs of *consecutive* occurrences hold a seed of each
run: at most one pair per word and class, however often a k-gram repeats.

Seeds are taken per lag from left to right; a table of the furthest word covered
on each lag's diagonal passes over those that an earlier extension has reached,
and the others are extended to both sides word by word. Runs of one class overlap
little, so the extensions of a text of n words cost about n log n comparisons.

K-grams get exact names by doubling (a name is the rank of a pair of shorter
names), and those that occur once in their text are dropped at every doubling, so
a text without repeats is left after the first few. Words carry the number of
their text, so no k-gram crosses two texts.

Texts are read batch by batch where they lie, without a shuffle. A batch is cut
to about GROUP_WORDS words; a longer text is a group of its own.

Defined results: a null text counts as empty and has no runs; repeated and null
keys are rows of their own; further columns go along only where ``carry`` names
them; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.llm.common import map_batches

#: A run has at least this many words, and this many copies of its period.
LEAST = 6
COPIES = 4
#: Words handled at once; bounds the arrays of a task (a longer text stands alone).
GROUP_WORDS = 1 << 18

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def named(first: np.ndarray, second: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the pairs (first, second) at ``places``: those that occur at least twice.

    Returns their places, ascending, and an array over all words with the name at
    each such place, -1 elsewhere. Pairs with a nameless part are nameless.
    """
    a = first[places]
    b = second
    both = (a >= 0) & (b >= 0)
    places, a, b = places[both], a[both], b[both]
    full = np.full(size, -1, dtype=np.int64)
    if len(places) == 0:
        return places, full
    _, names, counts = np.unique(a * (int(b.max()) + 1) + b, return_inverse=True, return_counts=True)
    often = counts[names] > 1
    places, names = places[often], names[often]
    full[places] = names
    return places, full


def at(names: np.ndarray, places: np.ndarray, step: int) -> np.ndarray:
    """Names ``step`` words after ``places``; -1 beyond the end."""
    out = np.full(len(places), -1, dtype=np.int64)
    inside = places + step < len(names)
    out[inside] = names[places[inside] + step]
    return out


def seeds(places: np.ndarray, names: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of consecutive occurrences of one name whose lag is in [low, high)."""
    order = np.argsort(names[places], kind="stable")
    here, name = places[order], names[places[order]]
    lag = here[1:] - here[:-1]
    right = (name[1:] == name[:-1]) & (lag >= low) & (lag < high)
    return here[:-1][right], lag[right]


def extend(code: np.ndarray, place: int, lag: int, k: int) -> tuple[int, int]:
    """The stretch [from, to) around ``place`` on which words equal those ``lag`` later."""
    end, width, last = place + k, 64, len(code) - lag
    while end < last:
        upto = min(end + width, last)
        differ = np.flatnonzero(code[end:upto] != code[end + lag:upto + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, width = upto, width * 2
    begin, width = place, 64
    while begin > 0:
        down = max(begin - width, 0)
        differ = np.flatnonzero(code[down:begin] != code[down + lag:begin + lag])
        if len(differ):
            begin = down + int(differ[-1]) + 1
            break
        begin, width = down, width * 2
    return begin, end


def runs_of(code: np.ndarray, longest: int, least: int = LEAST, copies: int = COPIES) -> np.ndarray:
    """All runs (start, length, period) in words ``code``, ascending by start, then period.

    ``code`` numbers the words of several texts, differently for each text;
    ``longest`` is the number of words of the longest text.
    """
    if copies < 3:
        raise ValueError("a run needs at least 3 copies of its period: below that, overlaps in a class fall short of it")
    found: list[tuple[int, int, int]] = []
    size = len(code)
    if size == 0:
        return np.zeros((0, 3), dtype=np.int64)
    # Names by number of words, a power of two; only words that occur again are kept.
    _, words, counts = np.unique(code, return_inverse=True, return_counts=True)
    places = np.flatnonzero(counts[words] > 1)
    full = np.full(size, -1, dtype=np.int64)
    full[places] = words[places]
    by_width = {1: (places, full)}

    def gram(k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and names of the k-grams that occur again."""
        if k not in by_width:
            half = 1 << ((k - 1).bit_length() - 1)  # the largest power of two below k
            p, f = gram(half)
            _, rest = gram(k - half)
            by_width[k] = named(f, at(rest, p, half), p, size)
        return by_width[k]

    covered: dict[int, int] = {}
    low = 1
    while copies * low <= longest:
        high = 2 * low
        # The overlap falls up to least / copies and rises from there.
        turn = [min(max(q, low), high - 1) for q in (low, least // copies, least // copies + 1, high - 1)]
        k = min(max(least, copies * q) - q for q in turn)
        p, f = gram(k)
        if len(p) == 0 and len(gram(low)[0]) == 0:
            break
        place, lag = seeds(p, f, low, high)
        for i in np.lexsort((place, lag)):
            q, s = int(lag[i]), int(place[i])
            if s < covered.get(q, 0):
                continue
            begin, end = extend(code, s, q, k)
            covered[q] = end
            if end - begin + q >= max(least, copies * q):
                found.append((begin, end - begin + q, q))
        low = high
        by_width = {w: v for w, v in by_width.items() if w >= low // 2 or w == 1}
    out = np.array(sorted((b, q, n) for b, n, q in found), dtype=np.int64).reshape(-1, 3)
    return out[:, [0, 2, 1]]


def groups_of(texts: Sequence[str]) -> Iterator[list[list[str]]]:
    """The words of each text, in groups of about GROUP_WORDS words."""
    group: list[list[str]] = []
    size = 0
    for text in texts:
        words = WORD.findall(text)
        if group and size + len(words) > GROUP_WORDS:
            yield group
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield group


def collapsed(words: Sequence[str], runs: np.ndarray) -> str:
    """The words joined by one space, without those that a run has after its first period."""
    if len(runs) == 0:
        return " ".join(words)
    step = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return " ".join(words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0))


def runs_in(texts: Sequence[str], least: int = LEAST, copies: int = COPIES) -> Iterator[tuple[np.ndarray, str]]:
    """The runs and the collapsed text of each text."""
    for group in groups_of(texts):
        lengths = np.array([len(w) for w in group], dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths)))
        flat = pa.array([w for words in group for w in words], pa.string()).dictionary_encode()
        kinds = len(flat.dictionary) + 1
        code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(np.arange(len(group)), lengths) * kinds
        runs = runs_of(code, int(lengths.max(initial=0)), least, copies)
        cut = np.searchsorted(runs[:, 0], starts)
        for i, words in enumerate(group):
            own = runs[cut[i]:cut[i + 1]] - np.array([starts[i], 0, 0])
            yield own, collapsed(words, own)


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, copies: int = COPIES, carry: Sequence[str] = (),
) -> DataFrame:
    """``key, runs, collapsed`` of every row of ``docs``, with the columns of ``carry`` as ``carry_<i>``.

    ``runs`` (start, length, period; by start, then period) are all periodic runs
    of the whole text, ``collapsed`` is the text with each run cut to its first
    period, words joined by one space.
    """
    rows = docs.select(
        F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        *(F.col(f"`{c}`").alias(f"carry_{i}") for i, c in enumerate(carry)))
    others = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*others, *T._parse_datatype_string(f"runs {RUNS}, collapsed string").fields])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for b in batches:
            results = list(runs_in(b.column("text").to_pylist(), least, copies))
            offsets = np.concatenate(([0], np.cumsum([len(r) for r, _ in results]))).astype(np.int32)
            flat = np.concatenate([r for r, _ in results] or [np.zeros((0, 3), dtype=np.int64)])
            parts = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)], fields=list(kind))
            keep = [b.column(f.name) for f in others]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.ListArray.from_arrays(pa.array(offsets), parts), pa.array([c for _, c in results], pa.string())],
                names=[*(f.name for f in others), "runs", "collapsed"])

    return map_batches(rows, mapped, schema).withColumnRenamed("id", key)
