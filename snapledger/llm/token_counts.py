"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a piece form a linked list; a heap holds its adjacent pairs by
merge rank, and the lowest-ranked (then leftmost) pair is merged until none is
left. The count is the number of initial symbols minus the number of merges;
no token identifiers are built.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import kept, map_batches, tokenizer_path

WORD_TOKENIZER = "word_bpe_49k.json"

#: Pieces are counted once per worker and kept, up to this many; longer pieces
#: than KEEP_CHARS are counted afresh each time.
KEEP_PIECES = 1_000_000
KEEP_CHARS = 64

#: White space as the tokenizer's patterns see it.
SPACE = "\\t\\n\\x0b\\x0c\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: str.split() also splits at these, which the tokenizer takes for symbols.
ODD_BREAKS = regex.compile("[\\x1c-\\x1f]")


def byte_symbols() -> list[str]:
    """The printable stand-in for each byte used by byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    table = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


def merges_made(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Number of merges that byte-pair encoding makes on ``symbols``."""
    n = len(symbols)
    sym = list(symbols)
    after = [*range(1, n), -1]
    before = list(range(-1, n - 1))
    heap = [(r[0], i) for i in range(n - 1) if (r := ranks.get((sym[i], sym[i + 1])))]
    heapq.heapify(heap)
    made = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if sym[i] < 0 or j < 0:
            continue
        found = ranks.get((sym[i], sym[j]))
        if not found or found[0] != rank:  # the pair has changed meanwhile
            continue
        made += 1
        sym[i], sym[j] = found[1], -1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            if new := ranks.get((sym[i], sym[k])):
                heapq.heappush(heap, (new[0], i))
        h = before[i]
        if h >= 0 and (new := ranks.get((sym[h], sym[i]))):
            heapq.heappush(heap, (new[0], h))
    return made


class WordCounter(dict):
    """Tokens by white-space-free chunk of text, for a word-end BPE vocabulary."""

    def __init__(self, path: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[a], vocab[b]] = (rank, vocab[a + b])
        letters = byte_symbols()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + end] for c in letters]
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]))
        self.split = regex.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[\\p{{L}}]+|[\\p{{N}}]|[^{SPACE}\\p{{L}}\\p{{N}}]+")
        self.pieces: dict[str, int] = {}

    def of_piece(self, piece: str) -> int:
        n = self.pieces.get(piece)
        if n is None:
            raw = piece.encode()
            symbols = [self.inner[b] for b in raw]
            symbols[-1] = self.last[raw[-1]]
            n = len(symbols) - merges_made(symbols, self.ranks)
            if len(piece) <= KEEP_CHARS:
                if len(self.pieces) >= KEEP_PIECES:
                    self.pieces.clear()
                self.pieces[piece] = n
        return n

    def __missing__(self, chunk: str) -> int:
        n = self.of_plain(chunk)
        if len(chunk) <= KEEP_CHARS:
            if len(self) >= KEEP_PIECES:
                self.clear()
            self[chunk] = n
        return n

    def of_plain(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma
        return sum(map(self.of_piece, self.split.findall(text.lower())))

    def of_text(self, text: str) -> int:
        """Tokens of a whole text; each special string in it is one token."""
        total = 0
        parts = [text]
        if "<|" in text:
            total = len(self.special.findall(text))
            parts = self.special.split(text)
        for part in parts:
            if ODD_BREAKS.search(part):
                total += self.of_plain(part)
            else:
                total += sum(map(self.__getitem__, part.split()))
        return total


def counter(tokenizer: str) -> WordCounter:
    """The worker's counter for a vocabulary file or a public tokenizer's name."""
    return kept(f"counter {tokenizer}", lambda: WordCounter(tokenizer_path(tokenizer)))


def token_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = WORD_TOKENIZER, limit: int = 2048
) -> DataFrame:
    """Tokens of every whole text: one row per input row, no shuffle.

    Returns ``key, n_bytes, n_tokens, over_limit``. A null text counts as empty
    (0 bytes, 0 tokens, not over the limit); a null key is kept; repeated rows
    give repeated rows; an empty table gives an empty result; other columns are
    not read, so their names can't clash.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counter(tokenizer)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            tokens = [words.of_text(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                ["key", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    out = map_batches(rows, count, "key long, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("key", key)
