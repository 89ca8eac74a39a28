"""Small tables with every awkward case, and brute-force versions of the operators."""

import random

import numpy as np
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
    # names that operators use inside
    T.StructField("key", T.StringType()), T.StructField("tie", T.LongType()), T.StructField("component", T.LongType()),
    T.StructField("fingerprint", T.StringType()), T.StructField("n_chars", T.LongType())])

WORDS = "the of and to in for sun moon river stone cloud garden winter window paper silver market letter".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


def texts() -> list[str | None]:
    rng = random.Random(5)
    base = prose(rng, 120)
    passage = prose(rng, 60)
    out: list[str | None] = [base, base, base.replace("sun", "moon", 1), None, "", "   ", "one", "a b c", "Ünï çödé ﬁ Σ ς é 　 中文 😀 <|endoftext|>"]
    out += [prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40) for _ in range(6)]
    out += ["ab" * 400, "x" * 500, "x" * 450 + "y", prose(rng, 6000), "é" * 300, "  two  spaces  ", "tab\tnew\n\nline \r\n end "]
    out += [prose(rng, rng.randint(1, 80)) for _ in range(20)]
    return out


def rows(ids: bool = True) -> list[tuple]:
    out = []
    for i, t in enumerate(texts()):
        out.append((i * 3 + 1, t, ["web", "books", None, "code"][i % 4], "k", 7, 8, "f", len(t or "")))
    if ids:  # repeated rows, an id used twice, rows without an id
        out += [out[0], (out[1][0], "another text under the same id", "web", "k", 7, 8, "f", 3), (None, out[0][1], None, None, None, None, None, None),
                (None, None, None, None, None, None, None, None)]
    return out


def table(spark, data):
    return spark.createDataFrame(data, DOCS).repartition(3)


def pages_of(keys: list[int], link) -> dict[int, int]:
    """Smallest key reachable, by brute force; ``link(i, j)`` on positions."""
    parent = list(range(len(keys)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            if link(i, j):
                parent[root(i)] = root(j)
    low: dict[int, int] = {}
    for i, k in enumerate(keys):
        low[root(i)] = min(low.get(root(i), k), k)
    return {i: low[root(i)] for i in range(len(keys))}


def repeats(docs: list[bytes], depth: int) -> list[np.ndarray]:
    """Which bytes are covered by a string of ``depth`` bytes that also starts earlier."""
    seen: set[bytes] = set()
    out = []
    for d in docs:
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - depth + 1):
            w = d[p:p + depth]
            if w in seen:
                gone[p:p + depth] = True
            seen.add(w)
        out.append(gone)
    return out
