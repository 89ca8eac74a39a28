"""Document fingerprints by a homomorphic multiset hash of paragraphs.

Each paragraph (a line, or a sentence of a line that has several) hashes to a
wide vector, and a document's fingerprint is the sum of its paragraphs' vectors
modulo powers of two. The sum doesn't depend on their order, and a paragraph is inserted or
deleted by adding or subtracting its vector. The vector has two parts:

* 256 lanes of +1 or -1, summed modulo 2**16. For two documents the scalar
  product of these lanes estimates how many paragraphs they share, so two
  fingerprints give a likeness without the texts.
* 8 uniform lanes, summed modulo 2**32: 256 bits for equality.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import bucket_of, map_batches, ordered_bounds, partitions_for

SIGNS, SUMS = 256, 8
#: Where a paragraph ends.
ENDS = re.compile(rb"\n|(?<=[.!?])[ \t]+")
#: Text bytes that one ordered bucket is meant to hold.
BUCKET_BYTES = 32 << 20


class Fingerprint:
    """The two sums; ``+`` inserts, ``-`` deletes."""

    __slots__ = ("signs", "sums")

    def __init__(self, signs: np.ndarray, sums: np.ndarray) -> None:
        self.signs, self.sums = signs, sums

    @classmethod
    def of(cls, paragraphs: Iterable[bytes]) -> Fingerprint:
        raw = b"".join([hashlib.blake2b(p, digest_size=SIGNS // 8 + 4 * SUMS).digest() for p in paragraphs])
        rows = np.frombuffer(raw, np.uint8).reshape(-1, SIGNS // 8 + 4 * SUMS)
        ones = np.unpackbits(rows[:, :SIGNS // 8], axis=1).sum(axis=0, dtype=np.int64)
        sums = np.ascontiguousarray(rows[:, SIGNS // 8:]).view("<u4").sum(axis=0, dtype=np.uint64)
        return cls((2 * ones - len(rows)).astype(np.uint16), sums.astype(np.uint32))

    @classmethod
    def of_text(cls, text: str) -> Fingerprint:
        return cls.of(paragraphs(text))

    @classmethod
    def parse(cls, s: str) -> Fingerprint:
        raw = base64.b64decode(s)
        return cls(np.frombuffer(raw, "<u2", SIGNS).astype(np.uint16), np.frombuffer(raw, "<u4", SUMS, 2 * SIGNS).astype(np.uint32))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.signs + other.signs, self.sums + other.sums)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.signs - other.signs, self.sums - other.sums)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and np.array_equal(self.sums, other.sums) and np.array_equal(self.signs, other.signs)

    def __hash__(self) -> int:
        return hash(str(self))

    def __str__(self) -> str:
        return base64.b64encode(self.signs.astype("<u2").tobytes() + self.sums.astype("<u4").tobytes()).decode()

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints; else about ``2 |A and B| / (|A| + |B|)`` for
        documents without repeated paragraphs, from 0 to 1."""
        if self == other:
            return 1.0
        a, b = self.signs.view(np.int16).astype(np.float64), other.signs.view(np.int16).astype(np.float64)
        size = float(a @ a + b @ b)
        return min(1.0, max(0.0, 2.0 * float(a @ b) / size)) if size else 0.0


def paragraphs(text: str) -> list[bytes]:
    """The lines of a text, a line of several sentences as its sentences; without
    outer white space, and none that is blank."""
    return [p for piece in ENDS.split(text.encode()) if (p := piece.strip())]


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_chars, fingerprint`` of every whole text; no shuffle.

    A null text counts as empty (the zero fingerprint); null keys and repeated
    rows are kept; an empty table gives an empty result; other columns are not
    read.
    """

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(list(map(len, texts)), pa.int64()),
                 pa.array([str(Fingerprint.of_text(t)) for t in texts], pa.string())], ["key", "n_chars", "fingerprint"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, one, "key long, n_chars long, fingerprint string").withColumnRenamed("key", key)


def neighbour_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document, of its edited text, and the two likenesses.

    The documents are dealt once into ordered buckets of the key. Each bucket
    also gets the first document of the next one (the last bucket: of the
    first), so every document meets the next in key order inside one task, which
    streams through its bucket. Repeated keys are ordered by text; null keys come
    last; a null text counts as empty; a single document follows itself; an empty
    table gives an empty result. Other columns are not read.

    Returns ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bounds = ordered_bounds(rows, "key", partitions_for(spark, total, BUCKET_BYTES))
    rows = rows.withColumn("bucket", bucket_of(F.col("key"), bounds))
    place = F.struct(F.col("key").isNull(), "key", "text")
    # One row per bucket: the first document of each goes to the bucket before.
    heads = rows.groupBy("bucket").agg(F.min(place).alias("head"))
    every = Window.orderBy("bucket")
    heads = heads.withColumn("to", F.coalesce(F.lag("bucket").over(every), F.max("bucket").over(Window.partitionBy())))
    guests = heads.select(F.col("head.key").alias("key"), F.col("head.text").alias("text"), F.col("to").alias("bucket"),
                          F.lit(True).alias("guest"))
    dealt = rows.withColumn("guest", F.lit(False)).unionByName(guests).repartitionById(len(bounds) + 1, "bucket")
    ordered = dealt.sortWithinPartitions("guest", F.col("key").asc_nulls_last(), "text").select("key", "text", "guest")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int | None, str, Fingerprint] | None = None
        for b in batches:
            out: list[tuple] = []
            for k, t, guest in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = Fingerprint.of_text(t)
                if held:
                    k0, t0, f0 = held
                    new = edited(t0, t)
                    f1 = Fingerprint.of_text(new)
                    out.append((k0, len(t0), hashlib.sha256(new.encode()).hexdigest(), str(f0), str(f1),
                                f0.likeness(f1), f0.likeness(own)))
                held = None if guest else (k, t, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), TYPES, strict=True)], NAMES)

    schema = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_batches(ordered, pairs, schema).withColumnRenamed("key", key)


NAMES = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
