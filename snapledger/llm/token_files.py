"""Token ids as binary shards with a minimal perfect hash index.

Documents are encoded in ascending key order and written as shards, each a
pair of files in a shared folder:

``shard-NNNNNN.ids``  raw little-endian ids (2 or 4 bytes each), nothing else;
``shard-NNNNNN.idx``  the index: a minimal perfect hash over the shard's keys,
                      a stored fingerprint per key, and the row offsets.

The hash is a cascade of bit arrays. At each level the keys left hash to bits;
a key alone on its bit is placed there, the others go to the next level. The
rank of its bit is the key's slot, so a lookup is a few probes whatever the
shard's size, and the slot's fingerprint tells keys that are not in the shard.

A task writes to a name of its own and renames the finished file, so a retried
or doubled task leaves one whole file.
"""

from __future__ import annotations

import io
import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, compress, repeat
from operator import is_

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import kept, map_batches, new_folder, partitions_for, tokenizer_path

BYTE_TOKENIZER = "byte_bpe_50k.json"
END_ID = 2

#: Text bytes a shard is meant to hold.
SHARD_BYTES = 32 << 20
#: Signs of a text that order the rows of a repeated key, before its hash.
PREFIX = 128

MAGIC = b"TOKIDX01"
#: Levels before the few keys left are listed one by one.
LEVELS = 24
#: Kept chunks per worker, and the longest kept.
KEEP_CHUNKS = 1_100_000
KEEP_CHARS = 64
#: Kept ends of words (runs of TAIL).
KEEP_TAILS = 20_000
#: Words encoded as one line.
JOINED = 64
#: Signs that form a piece of their own after a letter or a number.
TAIL = ".,;:!?#$%&*()[]{}<>|/\\\"+-=_~"

# --- encoding -----------------------------------------------------------------


class ChunkIds(dict):
    """Raw ids of a word with the space before it, by the tokenizers library.

    No piece of the split pattern reaches over a space that follows a
    character other than white space, so such words are encoded once. A run of
    TAIL after a letter or a number is a piece too, so a word that differs from a
    known one by such an end only is put together.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size < 1 << 16 else "<u4")
        #: Raw ids of the runs of TAIL at the end of words.
        self.tails: dict[str, bytes] = {}
        #: Whether an id's text begins with a space.
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def learn(self, words: set[str]) -> None:
        """Encode words that are not in the table, many in one call."""
        if len(self) + len(words) > KEEP_CHUNKS:
            self.clear()
        cores = {w: c for w in words if (c := w.rstrip(TAIL)) is not w and c[-1:].isalnum()}
        plain = {c for c in cores.values() if c not in self}.union(w for w in words if w not in cores)
        self.learn_plain([w for w in plain if len(w) <= KEEP_CHARS])
        for w, c in cores.items():
            raw = self.get(c)
            if raw is not None and len(w) <= KEEP_CHARS:
                tail = w[len(c):]
                if tail not in self.tails:
                    if len(self.tails) > KEEP_TAILS:
                        self.tails.clear()
                    self.tails[tail] = self.whole(tail)
                self[w] = raw + self.tails[tail]

    def learn_plain(self, new: list[str]) -> None:
        size = self.dtype.itemsize
        parts = [new[at:at + JOINED] for at in range(0, len(new), JOINED)]
        lines = [" " + " ".join(part) for part in parts]
        for part, got in zip(parts, self.tokenizer.encode_batch_fast(lines, add_special_tokens=False), strict=True):
            ids = np.array(got.ids, self.dtype)
            at = (np.flatnonzero(self.opens[ids]) * size).tolist()  # words have no space inside
            if len(at) != len(part):
                self.update((w, self.whole(" " + w)) for w in part)
                continue
            raw = ids.tobytes()
            self.update(zip(part, map(raw.__getitem__, map(slice, at, [*at[1:], None])), strict=True))

    def __missing__(self, word: str) -> bytes:
        return self.whole(" " + word)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The raw ids of whole texts."""
        # Runs of spaces, a space at the end and special strings need the text as a whole.
        split = [None if "  " in t or t.endswith(" ") or "<|" in t else t.split(" ") for t in texts]
        words = list(chain.from_iterable(w[1:] for w in split if w))
        ids = list(map(self.get, words))
        new = set(compress(words, map(is_, ids, repeat(None))))  # the table itself is never gone through
        if new:
            self.learn(new)
            ids = [self[w] if r is None else r for w, r in zip(words, ids, strict=True)]
        out, at = [], 0
        for t, w in zip(texts, split, strict=True):
            if w is None:
                out.append(self.whole(t))
            else:
                out.append(self.whole(w[0]) + b"".join(ids[at:at + len(w) - 1]))
                at += len(w) - 1
        return out


def encoder(tokenizer: str) -> ChunkIds:
    return kept(f"encoder {tokenizer}", lambda: ChunkIds(tokenizer_path(tokenizer)))


# --- the minimal perfect hash index ----------------------------------------------


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of integer keys."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (1 << 64) - 1)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: cascaded bit arrays with rank."""

    def __init__(self, bits: list[np.ndarray], rest: np.ndarray) -> None:
        self.bits, self.rest = bits, np.sort(rest)
        self.rank = [np.cumsum(b) - b for b in bits]
        sizes = [int(b.sum()) for b in bits]
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        bits, left = [], keys
        for level in range(LEVELS):
            if not len(left):
                break
            size = 2 * len(left) + 1
            at = (mixed(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(alone)
            left = left[~alone[at]]
        return cls(bits, left)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where the key can't be in the set."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, b in enumerate(self.bits):
            if not len(open_):
                return out
            at = (mixed(keys[open_], level) % np.uint64(len(b))).astype(np.int64)
            hit = b[at]
            out[open_[hit]] = self.base[level] + self.rank[level][at[hit]]
            open_ = open_[~hit]
        if len(open_) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            out[open_[hit]] = self.base[-1] + at[hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 977) >> np.uint64(32)).astype("<u4")


class ShardIndex:
    """Index of one shard: key -> rows -> offsets into the raw ids.

    Repeated keys share a slot, which holds their first row and row count.
    Rows with a null key follow all others and are reached as ``null_rows``.
    """

    def __init__(self, hash_: PerfectHash, stored: np.ndarray, first: np.ndarray, count: np.ndarray,
                 keys: np.ndarray, offsets: np.ndarray, width: int) -> None:
        self.hash, self.stored, self.first, self.count = hash_, stored, first, count
        self.keys, self.offsets, self.width = keys, offsets, width

    @classmethod
    def build(cls, keys: np.ndarray, lengths: np.ndarray, width: int) -> ShardIndex:
        """``keys``: ascending keys of the rows that have one; ``lengths``: ids of all rows."""
        distinct, first, count = np.unique(keys, return_index=True, return_counts=True)
        hash_ = PerfectHash.of(distinct)
        slot = hash_.slots(distinct)
        put = lambda values, kind: np.array(values, kind)[np.argsort(slot)]
        return cls(hash_, put(fingerprints(distinct), "<u4"), put(first, "<i8"), put(count, "<i4"),
                   keys.astype("<i8"), np.concatenate([[0], np.cumsum(lengths)]).astype("<i8"), width)

    def rows(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and row count of each key; 0 rows where the shard hasn't the key."""
        slot = self.hash.slots(keys)
        found = slot >= 0
        found[found] = self.stored[slot[found]] == fingerprints(keys[found])
        first, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        first[found], count[found] = self.first[slot[found]], self.count[slot[found]]
        return first, count

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        out.write(MAGIC + struct.pack("<IIQQQI", self.width, len(self.hash.bits), len(self.stored), len(self.keys),
                                      len(self.offsets) - 1, len(self.hash.rest)))
        for b in self.hash.bits:
            out.write(struct.pack("<Q", len(b)) + np.packbits(b).tobytes())
        for a, kind in ((self.hash.rest, "<i8"), (self.stored, "<u4"), (self.first, "<i8"), (self.count, "<i4"),
                        (self.keys, "<i8"), (self.offsets, "<i8")):
            out.write(np.asarray(a, kind).tobytes())
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> ShardIndex:
        if raw[:8] != MAGIC:
            raise ValueError("not a shard index")
        width, levels, distinct, keyed, rows, rest = struct.unpack_from("<IIQQQI", raw, 8)
        at = 8 + struct.calcsize("<IIQQQI")
        bits = []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", raw, at)
            size = -(-n // 8)
            bits.append(np.unpackbits(np.frombuffer(raw, np.uint8, size, at + 8), count=n).astype(bool))
            at += 8 + size
        parts = []
        for n, kind in ((rest, "<i8"), (distinct, "<u4"), (distinct, "<i8"), (distinct, "<i4"), (keyed, "<i8"), (rows + 1, "<i8")):
            parts.append(np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize
        return cls(PerfectHash(bits, parts[0]), *parts[1:], width)


# --- files ---------------------------------------------------------------------


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI and the folder in it."""
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    found, path = fs.FileSystem.from_uri(uri)
    return found, path


def put_whole(folder: str, name: str, chunks: Iterable[bytes]) -> None:
    """Write under a name of this attempt's own, then rename."""
    files, base = store(folder)
    files.create_dir(base, recursive=True)
    tmp = f"{base}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(tmp) as f:
        for c in chunks:
            f.write(c)
    files.move(tmp, f"{base}/{name}")


def get_whole(folder: str, name: str) -> bytes:
    files, base = store(folder)
    with files.open_input_file(f"{base}/{name}") as f:
        return f.read()


def write_token_files(
    docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", tokenizer: str = BYTE_TOKENIZER,
    end_id: int | None = END_ID, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Encode every whole text and write the shards; returns the manifest.

    The manifest has one row per shard, in key order: ``shard, n_docs,
    n_tokens, start`` (ids in the shards before it). Rows are ordered by key,
    repeated keys by the first ``PREFIX`` signs of the text, then by its hash; null
    keys come last. A key of many rows runs over several shards. A null text counts as empty.
    An empty table gives an empty manifest and no files. Other columns are not
    read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Equal texts of a key are told apart by their place in the input, so any key can be cut.
    rows = rows.select("key", "text", F.substring("text", 1, PREFIX).alias("prefix"), F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("place"))
    order = [F.col("key").asc_nulls_last(), F.col("prefix"), F.col("hash"), F.col("place")]
    spread = rows.repartitionByRange(partitions_for(spark, total, shard_bytes), *order).sortWithinPartitions(*order).select("key", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(tokenizer)
        end = b"" if end_id is None else np.array([end_id], enc.dtype).tobytes()
        size = enc.dtype.itemsize
        shard = TaskContext.get().partitionId()
        full = (b for b in batches if b.num_rows)
        first = next(full, None)
        if first is None:
            return
        keys: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def ids() -> Iterator[bytes]:
            for b in chain([first], full):
                raw = [r + end for r in enc.encode(b.column(1).to_pylist())]
                keys.append(np.asarray(b.column(0).drop_null(), np.int64))
                sizes.append(np.array([len(r) // size for r in raw], np.int64))
                yield b"".join(raw)

        put_whole(folder, f"shard-{shard:06d}.ids", ids())
        lengths = np.concatenate(sizes)
        n = len(lengths)
        index = ShardIndex.build(np.concatenate(keys), lengths, size)
        put_whole(folder, f"shard-{shard:06d}.idx", [index.to_bytes()])
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([n], pa.int64()), pa.array([int(lengths.sum())], pa.int64())],
            ["shard", "n_docs", "n_tokens"])

    made = map_batches(spread, write, "shard int, n_docs long, n_tokens long")
    path = new_folder(spark, "token-manifest")
    made.write.parquet(path)  # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(made.schema).parquet(path).withColumn(
        "start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def read_token_files(manifest: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Every document's ids read back through the index, one task per shard.

    Returns ``key, start, n_tokens, ids_crc32`` (``start``: ids of all documents
    before it; the crc is of the ids as little-endian unsigned 32-bit integers).
    """
    n = manifest.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, start in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), strict=True):
                index = ShardIndex.from_bytes(get_whole(folder, f"shard-{shard:06d}.idx"))
                ids = np.frombuffer(get_whole(folder, f"shard-{shard:06d}.ids"), f"<u{index.width}")
                distinct = np.unique(index.keys)
                first, count = index.rows(distinct)
                keys = np.repeat(distinct, count)
                # The rows of each key, then those without a key.
                row = np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(keys))
                nulls = np.arange(len(index.keys), len(index.offsets) - 1)
                row = np.concatenate([row, nulls]).astype(np.int64)
                lo, hi = index.offsets[row], index.offsets[row + 1]
                crc = [zlib.crc32(ids[i:j].astype("<u4").tobytes()) for i, j in zip(lo.tolist(), hi.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*keys.tolist(), *[None] * len(nulls)], pa.int64()), pa.array(lo + start, pa.int64()),
                     pa.array(hi - lo, pa.int64()), pa.array(crc, pa.int64())],
                    ["key", "start", "n_tokens", "ids_crc32"])

    numbered = manifest.withColumn("nth", F.row_number().over(Window.orderBy("shard")).cast("int") - 1)
    return map_batches(numbered.repartitionById(max(n, 1), "nth"), read, "key long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("key", key)


def token_files(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None, **options) -> DataFrame:
    """Write the shards of ``docs`` to ``folder`` (default: a new one in the
    shared folder) and return what :func:`read_token_files` reads back."""
    folder = folder or new_folder(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, key, text, **options), folder, key)
