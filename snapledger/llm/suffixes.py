"""Removal of repeated byte strings by depth-limited radix ordering of suffixes.

Only the first ``depth`` bytes of a suffix matter: suffixes that agree in them
are exactly the repeated windows, so ordering stops there. The passes go from
the most significant digit down:

1. The first digit of a suffix is its anchor: of the GRAM-byte strings inside its
   first ``depth`` bytes, the one with the least hash. Equal windows have equal
   anchors at equal offsets, and neighbouring suffixes mostly share theirs, so a
   run of suffixes travels as one short record instead of one record each.
2. The second digit is a hash of the run's whole span. Equal spans repeat window
   by window: all but the first are removed. Anchors met once drop out.
3. Spans that share an anchor but differ are fetched, and their suffixes are
   ordered by anchor offset and then eight bytes at a time down to ``depth``;
   groups of one drop out at every pass, groups left at the end are repeats.

Records are packed per digit by each task. A run met again in the same task is
removed there, so a passage that very many documents share is sent once per task.
The texts are dealt by key twice (to fetch spans, and to cut the texts).
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.llm.common import map_batches, partitions_for, written

DEPTH = 100
GRAM = 32
#: Bytes hashed at once, and text bytes whose runs a task holds before it sends them.
CHUNK = 1 << 19
HOLD = 48 << 20
#: Text bytes per first digit and per bucket of keys.
DIGIT_BYTES = 16 << 20
BUCKET_BYTES = 32 << 20
#: Differing spans of one anchor that one task orders; more are dealt by window.
CROWD = 1 << 16
#: Suffixes that a task orders at once.
ORDERED = 1 << 20

NO_KEY = (1 << 63) - 1

PLACE = np.uint64((1 << 24) - 1)
ODD = 0x9E3779B97F4A7C15


# --- packed columns --------------------------------------------------------------


def pack(columns: list[np.ndarray], tail: bytes = b"") -> bytes:
    """Integer columns as offsets from their least value in as few bytes as fit."""
    out = [struct.pack("<II", len(columns[0]), len(columns))]
    for c in columns:
        if c.dtype == np.uint64:
            base, kind, rest = 0, 8, c
        else:
            base = int(c.min()) if len(c) else 0
            rest = (c.astype(np.int64).view(np.uint64) - np.uint64(base & (1 << 64) - 1)) if len(c) else c
            top = int(rest.max()) if len(c) else 0
            kind = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
        out.append(struct.pack("<qB", base, kind) + rest.astype(f"<u{kind}").tobytes())
    return b"".join([*out, tail])


def unpack(raw: bytes) -> tuple[list[np.ndarray], bytes]:
    """The columns (signed; bit patterns kept) and the tail."""
    n, width = struct.unpack_from("<II", raw)
    at, out = 8, []
    for _ in range(width):
        base, kind = struct.unpack_from("<qB", raw, at)
        got = np.frombuffer(raw, f"<u{kind}", n, at + 9).astype(np.uint64) + np.uint64(base & (1 << 64) - 1)
        out.append(got.view(np.int64))
        at += 9 + n * kind
    return out, raw[at:]


def joined(packs: list[bytes], width: int) -> list[np.ndarray]:
    cols = [unpack(p)[0] for p in packs]
    return [np.concatenate([c[i] for c in cols]) if cols else np.empty(0, np.int64) for i in range(width)]


def dealt(to: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """One pack per destination."""
    order = np.argsort(to, kind="stable")
    to = to[order]
    starts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else []
    for s, e in zip(starts, np.append(starts[1:], len(to)) if len(to) else [], strict=True):
        part = order[s:e]
        yield int(to[s]), pack([c[part] for c in columns])


# --- runs of suffixes ----------------------------------------------------------


class Hashes:
    """Polynomial hashes modulo 2**64 of all substrings, from prefix sums."""

    def __init__(self) -> None:
        rng = np.random.default_rng(17)
        self.table = [rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
        self.base = int(rng.integers(1 << 40, 1 << 62)) | 1
        self.power = self.inverse = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.power) < n:
            one = np.ones(1, np.uint64)
            self.power = np.concatenate([one, np.cumprod(np.full(n, self.base, np.uint64))])
            self.inverse = np.concatenate([one, np.cumprod(np.full(n, pow(self.base, -1, 1 << 64), np.uint64))])

    def sums(self, data: np.ndarray, which: int) -> np.ndarray:
        self.reach(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[which][data] * self.power[:len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.inverse[start])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


_HASHES: list[Hashes] = []


def hashes() -> Hashes:
    if not _HASHES:
        _HASHES.append(Hashes())
    return _HASHES[0]


def runs_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int, gram: int) -> list[np.ndarray]:
    """Runs of suffixes of the texts data[start:end]: anchor hash, span hash,
    first suffix, suffixes, offset of the anchor (places are in ``data``)."""
    h, n = hashes(), len(data)
    long_ = ends - starts >= depth
    if not long_.any():
        return [np.empty(0, np.uint64), np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3]
    with np.errstate(over="ignore"):
        first = h.sums(data, 0)
        anchors = mix((first[gram:] - first[:-gram]) * h.inverse[:n - gram + 1])
        low = anchors & ~PLACE | np.arange(len(anchors), dtype=np.uint64)
        wide, least = depth - gram + 1, 1
        while 2 * least <= wide:  # least of 2, 4, 8, ... neighbours
            low = np.minimum(low[:-least], low[least:])
            least *= 2
        low = np.minimum(low[:n - depth + 1], low[wide - least:][:n - depth + 1])
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, starts[long_], 1)
        np.add.at(edge, ends[long_] - depth + 1, -1)
        at = np.flatnonzero(np.cumsum(edge)[:n - depth + 1])
        anchor = (low[at] & PLACE).astype(np.int64)
        begin = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        count = np.diff(np.append(begin, len(at)))
        p, anchor = at[begin], anchor[begin]
        span = h.of(h.sums(data, 1), p, p + count + depth - 1)
        a = anchors[anchor]
        span = mix(span ^ a * np.uint64(ODD) ^ (count * 256 + anchor - p).astype(np.uint64) * np.uint64(0x94D049BB133111EB))
    return [a, span, p, count, anchor - p]


def digits_of(batches: Iterator[pa.RecordBatch], digits: int, depth: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Packed runs by first digit; runs met before in the task are removed at once."""
    held: list[list[np.ndarray]] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        a, span, key, tie, p, count, off = (np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((p, tie, key, span))
        new = np.concatenate([[True], span[order][1:] != span[order][:-1]])
        again, own = order[~new], order[new]
        # Removed runs pass through the digit's task on their way to the texts.
        rows = [(d, 1, raw) for d, raw in dealt((key[again] ^ tie[again]) % digits, [key[again], tie[again], p[again], count[again]])]
        to = (a[own] >> np.uint64(32)).astype(np.int64) % digits
        low = (a[own] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        rows += [(d, 0, raw) for d, raw in dealt(to, [low, span[own], key[own], tie[own], p[own], count[own], off[own]])]
        yield from packed_rows(rows)

    def take(texts: list[tuple[int, int, int, bytes]]) -> None:
        sizes = np.array([len(t[3]) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        a, span, p, count, off = runs_of(np.frombuffer(b"".join(t[3] for t in texts), np.uint8), starts, ends, depth, gram)
        row = np.searchsorted(ends, p, side="right")
        col = lambda i: np.array([t[i] for t in texts], np.int64)[row]
        held.append([a, span, col(0), col(1), p - starts[row] + col(2), count, off])

    for b in batches:
        chunk: list[tuple[int, int, int, bytes]] = []
        room = 0
        for key, tie, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            raw = text.encode()
            # A text above a chunk goes piece by piece, each with the depth - 1 bytes after it.
            for at in range(0, max(len(raw), 1), CHUNK):
                part = raw[at:at + CHUNK + depth - 1]
                chunk.append((key, tie, at, part))
                room += len(part)
                if room >= CHUNK:
                    take(chunk)
                    size += room
                    chunk, room = [], 0
        if chunk:
            take(chunk)
            size += room
        if size >= HOLD:
            yield from flush()
            size = 0
    yield from flush()


def packed_rows(rows: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    if rows:
        to, kind, raw = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(kind, pa.int32()), pa.array(raw, pa.binary())], ["to", "kind", "raw"])


REMOVED, FETCH = 1, 2
PACKED = "to int, kind int, raw binary"


def repeated_runs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The runs of one first digit: repeats are removed; spans to compare are asked for."""
    runs: list[bytes] = []
    for b in batches:
        rows = []
        for kind, raw in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            if kind == 0:
                runs.append(raw)
            else:
                key, tie, p, count = unpack(raw)[0]
                rows += [(t, REMOVED, x) for t, x in dealt((key ^ tie) % buckets, [key, tie, p, count])]
        yield from packed_rows(rows)
    a, span, key, tie, p, count, off = joined(runs, 7)
    runs.clear()
    order = np.lexsort((p, tie, key, span, a))
    a, span, key, tie, p, count, off = (c[order] for c in (a, span, key, tie, p, count, off))
    if not len(a):
        return
    head = np.concatenate([[True], a[1:] != a[:-1]])
    new = head | np.concatenate([[True], span[1:] != span[:-1]])
    rows = [(t, REMOVED, x) for t, x in dealt(((key ^ tie) % buckets)[~new], [c[~new] for c in (key, tie, p, count)])]
    group = np.cumsum(head) - 1
    spans = np.bincount(group[new], minlength=group[-1] + 1)[group]
    ask = new & (spans > 1)
    crowd = (spans > CROWD).astype(np.int64)
    rows += [(t, FETCH, x) for t, x in dealt(((key ^ tie) % buckets)[ask], [c[ask] for c in (key, tie, p, count, off, a, crowd)])]
    yield from packed_rows(rows)


def fetched(batches: Iterator[pa.RecordBatch], digits: int, depth: int) -> Iterator[pa.RecordBatch]:
    """The spans asked for, packed by digit: those of an anchor together, those of
    a crowded anchor window by window."""
    packs: list[bytes] = []
    cols: list[np.ndarray] | None = None
    out: dict[int, list] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        rows = []
        for d, items in out.items():
            num = np.array([i[0] for i in items], np.int64).reshape(len(items), -1)
            rows.append((d, 0, pack(list(num.T), b"".join(i[1] for i in items))))
        out.clear()
        yield from packed_rows(rows)

    for b in batches:
        for key, tie, text, raw in zip(*(b.column(i).to_pylist() for i in (1, 2, 3, 5)), strict=True):
            if raw is not None:
                packs.append(raw)
                continue
            if cols is None:
                cols = joined(packs, 7)
                order = np.lexsort((cols[1], cols[0]))
                cols = [c[order] for c in cols]
            lo, hi = np.searchsorted(cols[0], [key, key + 1] if key < NO_KEY else [key, key], side="left")
            if key == NO_KEY:
                hi = len(cols[0])
            if lo == hi:
                continue
            own = [c[lo:hi][cols[1][lo:hi] == tie] for c in cols]
            data = text.encode()
            for _, _, p, count, off, a, crowd in zip(*(c.tolist() for c in own), strict=True):
                if not crowd:
                    out.setdefault(a % digits, []).append(((a, key, tie, p, count, off), data[p:p + count + depth - 1]))
                    size += count + depth + 48
                else:
                    for i in range(count):
                        w = data[p + i:p + i + depth]
                        d = int.from_bytes(hashlib.blake2b(w, digest_size=7).digest(), "little")
                        out.setdefault(d % digits, []).append(((a, key, tie, p + i, 1, off - i), w))
                        size += depth + 48
            if size >= HOLD:
                yield from flush()
                size = 0
    yield from flush()


def radix_groups(data: np.ndarray, at: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups of suffixes equal in their first ``depth`` bytes: (suffix, group) of
    those that have an equal. ``group``: the digit they were dealt by so far."""
    left = np.arange(len(at))
    words = np.zeros(len(data) + 8, np.uint8)
    words[:len(data)] = data
    for byte in range(0, depth, 8):
        if not len(left):
            break
        step = min(8, depth - byte)
        digit = np.zeros(len(left), np.uint64)
        for i in range(step):
            digit = digit << np.uint64(8) | words[at[left] + byte + i]
        order = np.lexsort((digit, group))
        left, digit, group = left[order], digit[order], group[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])])
        group = np.cumsum(new) - 1
        more = np.bincount(group)[group] > 1
        left, group = left[more], group[more]
    return left, group


def ordered_spans(batches: Iterator[pa.RecordBatch], buckets: int, depth: int) -> Iterator[pa.RecordBatch]:
    """Suffixes of one digit's spans, ordered to ``depth``: all but the first of every group are removed."""
    cols, tails = [], []
    for b in batches:
        for raw in b.column(2).to_pylist():
            c, tail = unpack(raw)
            cols.append(c)
            tails.append(tail)
    if not cols:
        return
    a, key, tie, p, count, off = (np.concatenate(c) for c in zip(*cols, strict=True))
    data = np.frombuffer(b"".join(tails), np.uint8)
    begin = np.cumsum(count + depth - 1) - (count + depth - 1)
    # Anchors are dealt part by part, and a part by alignment to its anchors (suffixes aligned
    # otherwise are never equal), so that a task orders at most ORDERED suffixes at a time.
    order = np.argsort(a, kind="stable")
    a_sorted, total = a[order], np.cumsum(count[order])
    cut, rows = 0, []
    while cut < len(order):
        upto = int(np.searchsorted(total, (total[cut - 1] if cut else 0) + ORDERED, side="right"))
        upto = int(np.searchsorted(a_sorted, a_sorted[max(upto, cut + 1) - 1], side="right"))
        part = order[cut:upto]
        cut = upto
        low, high = int((off[part] - count[part]).min()) + 1, int(off[part].max()) + 1
        width = max(1, ORDERED // len(part))  # a span has one suffix of each alignment at most
        for r in range(low, high, width):
            first = np.maximum(0, off[part] - (r + width) + 1)
            many = np.maximum(0, np.minimum(count[part], off[part] - r + 1) - first)
            run = np.repeat(part, many)
            nth = np.arange(len(run)) - np.repeat(np.cumsum(many) - many - first, many)
            _, group = np.unique(a[run] * 256 + off[run] - nth, return_inverse=True)
            left, group = radix_groups(data, begin[run] + nth, group, depth)
            if not len(left):
                continue
            k, t, q = key[run][left], tie[run][left], (p[run] + nth)[left]
            by = np.lexsort((q, t, k, group))
            again = by[np.concatenate([[False], group[by][1:] == group[by][:-1]])]
            k, t, q = k[again], t[again], q[again]
            rows += [(d, REMOVED, x) for d, x in dealt((k ^ t) % buckets, [k, t, q, np.ones(len(q), np.int64)])]
    yield from packed_rows(rows)


def spans_of(p: np.ndarray, count: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte spans covered by the suffixes' first ``depth`` bytes."""
    order = np.argsort(p, kind="stable")
    lo, hi = p[order], np.maximum.accumulate(p[order] + count[order] + depth - 1)
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    return lo[new], hi[np.append(np.flatnonzero(new)[1:] - 1, len(hi) - 1)]


def cut_texts(batches: Iterator[pa.RecordBatch], depth: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    """The texts of one bucket without their removed spans; columns after the packs' go along."""
    packs: list[bytes] = []
    cols: list[np.ndarray] | None = None
    for b in batches:
        out = []
        for key, tie, text, raw in zip(*(b.column(i).to_pylist() for i in (1, 2, 3, 5)), strict=True):
            if raw is not None:
                packs.append(raw)
                continue
            if cols is None:
                cols = joined(packs, 4)
                order = np.lexsort((cols[1], cols[0]))
                cols = [c[order] for c in cols]
            data = text.encode()
            n = len(data)
            lo = int(np.searchsorted(cols[0], key))
            hi = int(np.searchsorted(cols[0], key, side="right"))
            own = cols[1][lo:hi] == tie
            start, end = spans_of(cols[2][lo:hi][own], cols[3][lo:hi][own], depth) if own.any() else ((), ())
            if len(start):
                edges = [0, *np.stack([start, end], 1).ravel().tolist(), n]
                data = b"".join([data[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)])
            row = (key, tie, n, n - len(data), len(start), hashlib.sha256(data).hexdigest())
            out.append((*row, data.decode("utf-8", "ignore")) if with_text else row)
        if out:
            kinds = [pa.int64()] * 5 + [pa.string()] * (2 if with_text else 1)
            own = b.filter(b.column(5).is_null())
            names = ["key", "tie", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:len(kinds)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)), *own.columns[6:]],
                                             [*names, *b.schema.names[6:]])


def prime_from(n: int) -> int:
    """The least prime not below ``n``: buckets by remainder stay even for keys in steps."""
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH, gram: int = GRAM, with_text: bool = True,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Every text without the bytes covered by a ``depth``-byte string that also
    starts earlier (smaller key, or same document and earlier start).

    Returns ``key, n_bytes, n_removed, n_spans, kept_sha256`` and, when
    ``with_text``, ``kept`` (what is left as a string; a character cut in two is
    left out). A null text counts as empty; texts shorter than ``depth`` stay as
    they are. Rows that share a key, and rows without one (they come last), are
    documents of their own, in the order of a number given when they are first
    read. An empty table gives an empty result. The columns named in ``carry``
    are returned as ``carry_0``, ``carry_1``, ...; others are not read.
    """
    spark = docs.sparkSession
    along = [f"carry_{i}" for i in range(len(carry))]
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("key"), F.col(key).isNull().alias("nokey"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                       *(F.col(f"`{c}`").alias(a) for c, a in zip(carry, along, strict=True)))
    total, n = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    if rows.where("NOT nokey").select("key").distinct().count() == n:
        rows = rows.withColumn("tie", F.lit(0).cast("long"))
    else:  # rows that share a key need a number that stays the same
        rows = written(rows.withColumn("tie", F.monotonically_increasing_id()), "suffix-rows")
    texts = rows.select("key", "tie", "text")
    digits = partitions_for(spark, total or 0, DIGIT_BYTES)
    buckets = prime_from(partitions_for(spark, total or 0, BUCKET_BYTES))

    runs = map_batches(texts, lambda it: digits_of(it, digits, depth, gram), PACKED)
    found = written(runs.repartitionById(digits, "to").mapInArrow(lambda it: repeated_runs(it, buckets), PACKED), "suffix-runs")

    def beside_texts(packs: DataFrame, more: Sequence[str] = ()) -> DataFrame:
        """Texts dealt to buckets by key, each bucket's packs before them."""
        own = rows.select("key", "tie", "text", *more).withColumn("to", F.pmod(F.col("key").bitwiseXOR(F.col("tie")), F.lit(buckets)).cast("int"))
        none = own.select("to", "key", "tie", "text", F.lit(1).alias("late"), F.lit(None).cast("binary").alias("raw"), *more)
        head = packs.select("to", F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("tie"),
                            F.lit("").alias("text"), F.lit(0).alias("late"), "raw",
                            *(F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in more))
        return head.union(none).repartitionById(buckets, "to").sortWithinPartitions("late")

    spans = map_batches(beside_texts(found.where(f"kind = {FETCH}")), lambda it: fetched(it, digits, depth), PACKED)
    more = written(spans.repartitionById(digits, "to").mapInArrow(lambda it: ordered_spans(it, buckets, depth), PACKED), "suffix-spans")
    removed = found.where(f"kind = {REMOVED}").union(more)
    schema = "key long, tie long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept string" if with_text else "")
    types = T._parse_datatype_string(schema)
    types = T.StructType([*types.fields, *(T.StructField(c, rows.schema[c].dataType) for c in along)])
    out = map_batches(beside_texts(removed, along), lambda it: cut_texts(it, depth, with_text), types)
    return out.select(F.when(F.col("key") < NO_KEY, F.col("key")).alias(key), *out.columns[2:])
