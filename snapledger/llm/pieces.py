"""SentencePiece (merge-type) encoding by a table of prefixes, and decoding.

For a merge-type vocabulary every prefix of a unit has one encoding, so it has
one last token. Going through the unit, the vocabulary entries that end at a
position come from an automaton; the last token of that prefix is the one entry
that may follow the last token of the prefix before it. Two tokens may stand
side by side when merging their joined text gives the two of them back. The
ids are then read off backwards from the end of the table.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import kept, map_batches, tokenizer_path

PIECE_MODEL = "piece_bpe_32k.model"

SPACE = "▁"
#: Units kept per worker in each of two generations, and the longest kept.
KEEP_UNITS = 700_000
KEEP_CHARS = 64
#: Answers of the pair test kept per worker in each of two generations.
KEEP_PAIRS = 300_000


class PieceTable(dict):
    """Raw ids of each unit of text.

    A unit is a run of spaces with the characters up to the next space. No
    vocabulary entry reaches over the end of a unit, so units are independent.
    Most units have one space in front, so the key of such a unit leaves it out;
    the key of a line's first word begins with the line break, and that of any
    other unit with a space of its own.

    When the table is full it becomes the old generation, and what is met again
    moves back from there.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.piece = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [i for i in range(len(self.piece))
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {self.piece[i]: i for i in plain}
        self.score = {i: model.get_score(i) for i in plain}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.bytes)}
        self.old: dict[str, bytes] = {}
        self.dtype = np.dtype("<u2" if len(self.piece) <= 1 << 16 else "<u4")
        self.packed = [np.array(i, self.dtype).tobytes() for i in range(len(self.piece))]
        self.digits = [str(i) for i in range(len(self.piece))]
        self.shown = [p.replace(SPACE, " ") for p in self.piece]
        #: Byte entries that are a character alone show as it; the others need their neighbours.
        self.is_byte = np.zeros(len(self.piece), bool)
        for b, i in enumerate(self.bytes):
            self.is_byte[i] = b >= 128
            self.shown[i] = chr(b) if b < 128 else ""
        wide = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) or (p[:2] == SPACE * 2 and p.strip(SPACE)) for p in wide):
            raise ValueError("an entry reaches over the end of a unit")
        # A character that is in no longer entry always stands alone.
        joined = set("".join(wide))
        alone = "".join(regex.escape(c) for c in "\n\t\r" if c not in joined)
        self.cut = regex.compile(f" *[^ {alone}]+| +|[{alone}]" if alone else " *[^ ]+| +")
        self.lines = "\n" not in joined
        #: Signs that leave no text to be cut at single spaces and line breaks alone.
        self.odd = ["  ", *(c for c in "\t\r" if c not in joined)]
        self.known = frozenset(c for c in self.ids if len(c) == 1)
        self.ends = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if p.strip(SPACE) or len(p) == 1:
                self.ends.add_word(p, (i, len(p)))
        self.ends.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.old_pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        #: Place in the order of merges; characters come before all merges.
        self.rank = dict.fromkeys(plain, -1)
        for place, i in enumerate(sorted((i for i in plain if len(self.piece[i]) > 1), key=lambda i: -self.score[i])):
            self.rank[i] = place
        self.half: dict[int, tuple[int, int]] = {}
        self.runs: dict[int, list[int]] = {}

    def merged(self, text: str, trace: list[tuple[str, str]] | None = None) -> list[str]:
        """The symbols left when no adjacent pair forms an entry: best score, then
        leftmost, first. ``trace`` gets the merges made."""
        sym: list[str] = list(text)
        n = len(sym)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if i >= 0 and j >= 0 and (k := self.ids.get(both := sym[i] + sym[j])) is not None:
                heapq.heappush(heap, (-self.score[k], i, both))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if not sym[i] or j < 0 or sym[i] + sym[j] != both:
                continue
            if trace is not None:
                trace.append((sym[i], sym[j]))
            sym[i], sym[j] = both, ""
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i)
            offer(before[i])
        return [s for s in sym if s]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging the joined text of ``a`` and ``b`` gives the two of them."""
        pair = a << 32 | b
        ok = self.pairs.get(pair)
        if ok is None:
            ok = self.old_pairs.get(pair)
            if ok is None:
                ok = self.apart(a, b)
            if len(self.pairs) >= KEEP_PAIRS:
                self.old_pairs, self.pairs = self.pairs, {}
            self.pairs[pair] = ok
        return ok

    def apart(self, a: int, b: int) -> bool:
        """Whether no merge over the border of ``a`` and ``b`` comes before the merges
        that make them: going back in time, the one made last is split again."""
        limit = len(self.piece)
        while True:
            over = self.ids.get(self.piece[a] + self.piece[b])
            if over is not None and self.rank[over] < limit:
                return False
            x, y = self.rank[a], self.rank[b]
            if x < 0 and y < 0:
                return True
            if x > y:
                limit, a = x, self.halves(a)[1]
            else:  # of two equal merges the left one comes first
                limit, b = y + 1, self.halves(b)[0]

    def halves(self, a: int) -> tuple[int, int]:
        """The two entries whose merge makes entry ``a``."""
        got = self.half.get(a)
        if got is None:
            trace: list[tuple[str, str]] = []
            self.merged(self.piece[a], trace)
            got = self.half[a] = (self.ids[trace[-1][0]], self.ids[trace[-1][1]])
        return got

    def stands(self, a: int) -> bool:
        """Whether merging the text of ``a`` gives ``a`` itself."""
        ok = self.whole.get(a)
        if ok is None:
            ok = self.whole[a] = self.merged(self.piece[a]) == [self.piece[a]]
        return ok

    def of_known(self, text: str) -> list[int]:
        """Ids of a text whose characters are all entries: the prefix table, read backwards."""
        last: list[tuple[int, int] | None] = [None] * len(text)
        whole, pairs = self.whole, self.pairs
        for end, entry in self.ends.iter(text):
            if last[end] is not None:
                continue
            i, n = entry
            if n <= end:
                before = last[end - n]
                if before is None:
                    continue
            ok = whole.get(i)
            if not (self.stands(i) if ok is None else ok):
                continue
            if n <= end:
                ok = pairs.get(before[0] << 32 | i)
                if ok is None:
                    ok = self.may_follow(before[0], i)
                    pairs = self.pairs
                if not ok:
                    continue
            last[end] = entry
        out, at = [], len(text) - 1
        while at >= 0:
            i, n = last[at]
            out.append(i)
            at -= n
        return out[::-1]

    def of_run(self, n: int) -> list[int]:
        """Ids of ``n`` spaces in a row: entries of one and the same score, merged leftmost first."""
        if n not in self.runs:
            self.runs[n] = [self.ids[s] for s in self.merged(SPACE * n)]
        return self.runs[n]

    def of_unit(self, unit: str) -> list[int]:
        word = unit.lstrip(SPACE)
        lead = len(unit) - len(word)
        # Runs of spaces have the lowest score: only the last space can join the word.
        text = SPACE * min(lead, 1) + word
        out = self.of_known(text) if self.known.issuperset(text) else self.of_mixed(text)
        if lead > 1:
            free = out and out[0] == self.ids[SPACE]
            out = self.of_run(lead if free else lead - 1) + out[1 if free else 0:]
        return out

    def of_mixed(self, text: str) -> list[int]:
        """Ids of a text with characters that are no entries: these are spelt in bytes."""
        out: list[int] = []
        known = 0
        for at in range(len(text) + 1):
            if at == len(text) or text[at] not in self.known:
                if at > known:
                    out += self.of_known(text[known:at])
                if at < len(text):
                    out += [self.bytes[b] for b in text[at].encode()]
                known = at + 1
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: entries as they are, runs of byte entries as UTF-8."""
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.piece[i].replace(SPACE, " "))
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    def __missing__(self, key: str) -> bytes:
        raw = self.old.get(key)
        if raw is None:
            if key.startswith(" "):
                ids = self.of_unit(key[1:].replace(" ", SPACE))
            elif self.lines and key.startswith("\n"):
                ids = self.of_unit("\n") + (self.of_unit(key[1:]) if len(key) > 1 else [])
            else:
                ids = self.of_unit(SPACE + key)
            raw = b"".join(map(self.packed.__getitem__, ids))
        if len(key) <= KEEP_CHARS:
            if len(self) >= KEEP_UNITS:
                self.old = dict(self)
                self.clear()
            self[key] = raw
        return raw

    def units(self, text: str) -> list[str]:
        """The keys of a text's units."""
        text = text.replace(SPACE, " ")
        if self.lines and not text.startswith((" ", "\n")) and not any(c in text for c in self.odd):
            return text.replace("\n", " \n").split(" ")
        return [u[1:] if u[0] == " " and u[1:2] != " " else " " + u for u in self.cut.findall(" " + text)]

    def raw_ids(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        return np.frombuffer(b"".join(map(self.__getitem__, self.units(text))) if text else b"", self.dtype)

    def decoded(self, ids: np.ndarray) -> str:
        """The text of a whole text's ids, without the space put in front."""
        if self.is_byte[ids].any():
            return self.decode(ids.tolist())[1:]
        return "".join(map(self.shown.__getitem__, ids.tolist()))[1:]

    def joined(self, ids: np.ndarray) -> str:
        """Decimal ids joined by commas."""
        return ",".join(map(self.digits.__getitem__, ids.tolist()))

    def of_text(self, text: str) -> tuple[int, str, str]:
        """``(number of ids, ids joined by commas, decoded text)`` of a whole text."""
        ids = self.raw_ids(text)
        return len(ids), self.joined(ids), self.decoded(ids)

    def encode(self, text: str) -> list[int]:
        return self.raw_ids(text).tolist()


def piece_table(model: str) -> PieceTable:
    """The worker's table for a model file or a public tokenizer's name."""
    return kept(f"pieces {model}", lambda: PieceTable(tokenizer_path(model)))


def encode_pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = PIECE_MODEL, with_ids: bool = True
) -> DataFrame:
    """Ids of every whole text and the text decoded from them; no shuffle.

    Returns ``key, n_tokens, ids_sha256, decoded_sha256`` (lowercase hex of the
    comma-joined decimal ids and of the decoded UTF-8 text) and, when
    ``with_ids``, ``ids`` (array of int) and ``decoded``. A null text counts as
    empty (no ids, empty decoded text); null keys and repeated rows are kept;
    an empty table gives an empty result; other columns are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(model)
        for b in batches:
            counts, digests, back_digests, ids, backs = [], [], [], [], []
            for t in b.column(1).to_pylist():
                raw = table.raw_ids(t or "")
                joined, back = table.joined(raw), table.decoded(raw)
                counts.append(len(raw))
                digests.append(hashlib.sha256(joined.encode()).hexdigest())
                back_digests.append(hashlib.sha256(back.encode()).hexdigest())
                if with_ids:
                    ids.append(raw.astype(np.int32))
                    backs.append(back)
            cols = [b.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(back_digests, pa.string())]
            names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                cols += [pa.ListArray.from_arrays(ends, np.concatenate([*ids, np.zeros(0, np.int32)])), pa.array(backs, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "key long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    out = map_batches(rows, encode, schema + (", ids array<int>, decoded string" if with_ids else ""))
    return out.withColumnRenamed("key", key)
