"""Repair of conversation structure: generalised LR over the role grammar.

A conversation shall read ``S -> nothing | system T | T``, ``T -> user assistant |
T user assistant``. Rows may be kept, reroled, deleted, or empty rows inserted, at
a cost each; of the cheapest repairs the one whose edits read least in ASCII wins.

The rows of a conversation are parsed with a graph-structured stack. After every
row each live stack is one node: its top (what the reductions have left: nothing,
``s``, an open ``u`` or a closed turn ``a``; tops of one name have the same
continuations), its cost and the place of its audit among the audits of its level,
with a link to the node below it and the edits between. Stacks with equal tops
merge into the one with the least (cost, audit). Two audits of a level never
begin with each other (both end with the edit of the same row), so their order is
kept by whatever follows and a level needs only places, no strings. Levels that
agree up to their least cost are the same, and are computed once.

Rows are range-sorted by conversation, turn (nulls first), role and text, so a
task gets whole conversations but for those at its edges or with more than
SEGMENT_ROWS rows. Those are cut into segments: a segment is parsed from each of
the four tops that may stand before it and gives a table of (cost, place) from top
to top, the tables of a conversation are joined in order (few numbers each), and a
second pass reads each segment's edits between the tops so found. Equal rows are
counted in the map tasks before they are sorted.

Defined results: null roles and texts count as one space, a null conversation id
is a conversation of its own, null turns come first; rows of one turn are ordered
by role, then text; repeated rows are duplicates, or blank; further columns play
no part, whatever their names; an empty table gives empty results. The audit of a
conversation is one string (Spark's limit for one is 2 GB).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.llm.common import map_batches, ship, written

# Tops of the stack, shifts of the role grammar, its accepting tops, and the costs of edits.
TOPS = ("", "s", "u", "a")
SHIFTS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
ACCEPTING = ("", "a")
LEGAL_PAIRS = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
SPACE = " \t\n\x0b\x0c\r"

#: Rows and text bytes of one segment, at most: the unit of memory of the parser.
SEGMENT_ROWS = 1 << 15
SEGMENT_BYTES = 1 << 24
#: Repaired rows in one piece of a long conversation.
PIECE_ROWS = 4096

COUNTS = ("blank", "duplicate", "truncated", "illegal")
REPAIRED = "array<struct<role:string,text:string>>"

#: One level of the stack: for each top (cost, place of its audit), or None.
Level = tuple[tuple[int, int] | None, ...]
#: For each top the top below it and the edits between, or None.
Links = tuple[tuple[int, str] | None, ...]


def inserted(top: str) -> str:
    """The top after the only empty row that the grammar takes there (of a user or an assistant)."""
    return SHIFTS[top, "a"] if (top, "a") in SHIFTS else SHIFTS[top, "u"]


def reach(top: str) -> Iterator[tuple[str, int, str]]:
    """Tops after no, one and two inserted rows, their cost and edits (more come back to the same tops)."""
    for n in range(3):
        yield top, n * INSERT, "I" * n
        top = inserted(top)


@cache
def level_after(level: Level, initial: str, fault: str) -> tuple[Level, int, Links]:
    """The next level (least cost 0), the cost taken off it, and its links.

    ``initial``: the row's role initial; ``fault``: "delete" (it has to go),
    "truncated" or "".
    """
    best: dict[int, tuple[int, int, str, int]] = {}
    for below, node in enumerate(level):
        if node is None:
            continue
        for top, cost, edits in reach(TOPS[below]):
            steps = [(top, DELETE, "D")]
            if fault != "delete":
                extra = TRUNCATED if fault else 0
                steps += [(SHIFTS[top, initial], KEEP + extra, "K")] if (top, initial) in SHIFTS else []
                steps += [(SHIFTS[top, r], REROLE + extra, "R") for r in ROLES if (top, r) in SHIFTS]
            for after, more, edit in steps:
                found = (node[0] + cost + more, node[1], edits + edit, below)
                at = TOPS.index(after)
                best[at] = min(best.get(at, found), found)
    least = min(b[0] for b in best.values())
    places = {at: i for i, at in enumerate(sorted(best, key=lambda a: best[a][1:3]))}
    nodes = tuple((best[i][0] - least, places[i]) if i in best else None for i in range(len(TOPS)))
    return nodes, least, tuple((best[i][3], best[i][2]) if i in best else None for i in range(len(TOPS)))


def begun(top: int) -> Level:
    """The level of one stack with a top."""
    return tuple((0, 0) if i == top else None for i in range(len(TOPS)))


def accepted(level: Iterable[tuple[int, int] | None]) -> tuple[int, int, str]:
    """Cost, top and last edits of the best repair that ends at a level."""
    ends = []
    for at, node in enumerate(level):
        if node is not None:
            ends += [(node[0] + cost, node[1], edits, at) for top, cost, edits in reach(TOPS[at]) if top in ACCEPTING]
    cost, _, edits, at = min(ends)
    return cost, at, edits


def parse(rows: Iterable[tuple[str, str]], entry: int) -> tuple[Level, int, list[Links]]:
    """The last level, its least cost, and the links of all levels, over (initial, fault) of rows."""
    level, total, links = begun(entry), 0, []
    for initial, fault in rows:
        level, cost, link = level_after(level, initial, fault)
        total += cost
        links.append(link)
    return level, total, links


def edits_to(links: list[Links], top: int) -> list[str]:
    """The edits of each row along the links down from the last level's ``top``."""
    out = []
    for link in reversed(links):
        top, edits = link[top]
        out.append(edits)
    return out[::-1]


@dataclass
class Segment:
    """Consecutive rows of one conversation: their faults, counts and texts."""

    rows: list[tuple[str, str]] = field(default_factory=list)  # (initial, fault) of every row
    said: list[tuple[str, str]] = field(default_factory=list)  # (role, text) of every row
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(COUNTS, 0))
    first: str | None = None
    last: str | None = None
    low: int | None = None
    high: int | None = None
    turns: int = 0
    seen: set[tuple[str, str]] = field(default_factory=set)

    def add(self, turn: int | None, role: str, text: str, times: int, known: bool | None = None) -> None:
        """``times`` equal rows; ``known``: whether an equal row stands earlier (None: look among these rows)."""
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        initial, plain = role[:1], text.strip(SPACE)
        if self.last is not None and self.last + initial not in LEGAL_PAIRS:
            self.counts["illegal"] += 1
        if initial + initial not in LEGAL_PAIRS:
            self.counts["illegal"] += times - 1
        self.first = initial if self.first is None else self.first
        self.last = initial
        if known is None:
            known = (role, text) in self.seen
            self.seen.add((role, text))
        if not plain:
            self.counts["blank"] += times
            faults = ["delete"] * times
        else:
            cut = not known and plain[-1] not in ".!?"
            self.counts["duplicate"] += times - (not known)
            self.counts["truncated"] += cut
            faults = ["delete" if known else "truncated" if cut else "", *["delete"] * (times - 1)]
        self.rows += [(initial, f) for f in faults]
        self.said += [(role, text)] * times

    def repaired(self, entry: int, edits: list[str], end: str) -> Iterator[tuple[str, str]]:
        """(role, text) of the repaired rows, from the edits of every row and those at the end."""
        top = TOPS[entry]
        for (role, text), (initial, _), steps in zip(self.said, self.rows, edits):
            for e in steps:
                if e == "K":
                    top = SHIFTS[top, initial]
                    yield role, text
                elif e != "D":
                    top = inserted(top)
                    yield ROLES[top], text if e == "R" else ""
        for _ in end:
            top = inserted(top)
            yield ROLES[top], ""


@dataclass(frozen=True)
class Repaired:
    """``report``: one row per conversation (id, gaps, COUNTS, cost, audit).

    ``pieces``: id, piece (ascending), ``whole`` (the piece is all of it), and
    ``repaired`` (role and text of each row in order); none where no row is left.
    """

    report: DataFrame
    pieces: DataFrame


def _struct(spec: str) -> T.StructType:
    return T._parse_datatype_string(spec)


def _batch(rows: list[dict[str, Any]], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(schema: T.StructType, conv: pa.DataType) -> pa.Schema:
    """Arrow types of the columns this module makes; ``conv`` is the id's own."""
    said = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    links = pa.list_(pa.struct([(n, pa.int64()) for n in ("entry", "exit", "cost", "place")]))
    kinds = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32()}
    return pa.schema([(f.name, conv if f.name == "conv" else {"repaired": said, "links": links}.get(f.name) or kinds[f.dataType.simpleString()])
                      for f in schema.fields])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch as one, with their number."""
    for b in batches:
        keys = [n for n in b.schema.names if n != "times"]
        t = pa.Table.from_batches([b]).group_by(keys).aggregate([("times", "sum")]).rename_columns([*keys, "times"])
        yield from t.select(b.schema.names).cast(b.schema).combine_chunks().to_batches()


ROWS = "at bigint, part bigint, turn bigint, role string, text string, times bigint"
RESULT = f"gaps bigint, {', '.join(f'{c} bigint' for c in COUNTS)}, cost bigint, audit string"
COLUMNS = ("at", "conv", "turn", "role", "text", "times")


def _result(seg: Segment) -> dict[str, Any]:
    """The columns of RESULT and ``repaired`` of a whole conversation."""
    level, least, links = parse(seg.rows, 0)
    cost, top, end = accepted(level)
    edits = edits_to(links, top)
    said = [{"role": r, "text": t} for r, t in seg.repaired(0, edits, end)]
    gaps = 0 if seg.low is None else seg.high - seg.low + 1 - seg.turns
    return {"gaps": gaps, **seg.counts, "cost": least + cost, "audit": "".join(edits) + end, "repaired": said}


def _parted(schema: T.StructType, most_rows: int, most_bytes: int):
    """Maps sorted rows to results of whole conversations, and to rows of those that may go on in another task."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict[str, Any]] = []
        arrow = None
        conv, held, size, edge = None, [], 0, True  # edge: the conversation's rows go to segments
        part, part_rows, part_bytes = 0, 0, 0

        def close() -> None:
            """The conversation at hand is whole."""
            if held:
                seg = Segment()
                for row in held:
                    seg.add(*row[2:])
                out.append({"conv": conv, **_result(seg)})

        def hand_on() -> None:
            """The rows at hand go to segments."""
            nonlocal part, part_rows, part_bytes
            for at, c, turn, role, text, times in held:
                if part_rows == 0 or part_rows >= most_rows or part_bytes >= most_bytes:
                    part, part_rows, part_bytes = at, 0, 0
                part_rows, part_bytes = part_rows + times, part_bytes + len(text)
                out.append({"conv": c, "at": at, "part": part, "turn": turn, "role": role, "text": text, "times": times})

        begun_yet = False
        for b in batches:
            if arrow is None:
                arrow = _arrow(schema, b.schema.field("conv").type)
            for row in zip(*(b.column(n).to_pylist() for n in COLUMNS)):
                if not begun_yet or row[1] != conv:
                    if begun_yet:
                        hand_on() if edge else close()
                        edge = False
                    begun_yet, conv, held, size, part_rows = True, row[1], [], 0, 0
                held.append(row)
                size += len(row[4])
                if edge or len(held) >= most_rows or size >= most_bytes:
                    edge = True
                    hand_on()
                    held, size = [], 0
                if len(out) >= PIECE_ROWS:
                    yield _batch(out, arrow)
                    out = []
        if begun_yet:
            hand_on()  # the last conversation may go on in the next task
        if out:
            yield _batch(out, arrow)

    return mapped


def _segments(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, Segment, pa.DataType]]:
    """(values of ``names``, segment) of sorted rows; ``names`` begin with conv and part."""
    now, seg, kind = None, Segment(), None
    for b in batches:
        kind = b.schema.field("conv").type
        for head, row in zip(zip(*(b.column(n).to_pylist() for n in names)),
                             zip(*(b.column(n).to_pylist() for n in ("turn", "role", "text", "times", "known")))):
            if now is not None and head != now:
                yield now, seg, kind
                seg = Segment()
            now = head
            seg.add(*row)
    if now is not None:
        yield now, seg, kind


#: Turns go as text, so that a null beside them doesn't make them floats.
EDGES = "first string, last string, low string, high string, turns bigint"
LINKS = "links array<struct<entry:bigint,exit:bigint,cost:bigint,place:bigint>>"


def _tables(schema: T.StructType):
    """Maps sorted rows of segments to one row per segment: counts, edges and the table from top to top."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, part), seg, kind in _segments(batches, ("conv", "part")):
            links = []
            for entry in range(len(TOPS)):
                level, least, _ = parse(seg.rows, entry)
                links += [{"entry": entry, "exit": at, "cost": least + n[0], "place": n[1]} for at, n in enumerate(level) if n is not None]
            row = {"conv": conv, "part": part, **seg.counts, "first": seg.first, "last": seg.last, "turns": seg.turns, "links": links,
                   **{n: None if v is None else str(v) for n, v in (("low", seg.low), ("high", seg.high))}}
            yield _batch([row], _arrow(schema, kind))

    return mapped


def joined(tables: pd.DataFrame) -> pd.DataFrame:
    """The tops between the segments of one conversation, with its counts and cost.

    ``tables``: a row per segment (the columns of :func:`_tables`), any order.
    """
    tables = tables.sort_values("part")
    level: dict[int, tuple[int, int]] = {0: (0, 0)}
    chosen = []
    for links in tables["links"]:
        best: dict[int, tuple[int, int, int, int]] = {}
        for link in links:
            if (node := level.get(link["entry"])) is not None:
                found = (node[0] + link["cost"], node[1], link["place"], link["entry"])
                best[link["exit"]] = min(best.get(link["exit"], found), found)
        order = sorted(best, key=lambda x: best[x][1:3])
        level = {x: (best[x][0], order.index(x)) for x in best}
        chosen.append({x: b[3] for x, b in best.items()})
    cost, top, end = accepted([level.get(i) for i in range(len(TOPS))])
    entries, exits = [], []
    for entry_of in reversed(chosen):
        exits.append(top)
        top = entry_of[top]
        entries.append(top)
    ends = [""] * (len(tables) - 1) + [end]
    counts = {c: int(tables[c].sum()) for c in COUNTS}
    counts["illegal"] += sum(a + b not in LEGAL_PAIRS for a, b in zip(tables["last"][:-1], tables["first"][1:]))
    dated = tables[tables["low"].notna()]
    gaps = 0
    if len(dated):
        met = sum(a == b for a, b in zip(dated["high"][:-1], dated["low"][1:]))
        gaps = int(dated["high"].iloc[-1]) - int(dated["low"].iloc[0]) + 1 - (int(dated["turns"].sum()) - met)
    return pd.DataFrame({"conv": tables["conv"], "part": tables["part"], "entry": entries[::-1], "exit": exits[::-1], "end": ends,
                         "gaps": gaps, **counts, "cost": cost})


def _edited(schema: T.StructType):
    """Maps sorted rows of segments with their tops to audits and pieces."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, part, entry, top, end), seg, kind in _segments(batches, ("conv", "part", "entry", "exit", "end")):
            edits = edits_to(parse(seg.rows, entry)[2], top)
            arrow = _arrow(schema, kind)
            yield _batch([{"conv": conv, "part": part, "piece": -1, "audit": "".join(edits) + end, "repaired": None}], arrow)
            said = [{"role": r, "text": t} for r, t in seg.repaired(entry, edits, end)]
            for i in range(0, len(said), PIECE_ROWS):
                # A segment begins at its first row's number, so pieces of later segments come later.
                yield _batch([{"conv": conv, "part": part, "piece": part + i // PIECE_ROWS, "audit": None, "repaired": said[i:i + PIECE_ROWS]}], arrow)

    return mapped


def repair_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES,
) -> Repaired:
    """Repairs every conversation of ``rows``; see the module for the method and the results of awkward rows."""
    ship(rows.sparkSession)
    blank = F.lit(" ")
    plain = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                        F.coalesce(F.col(f"`{role}`").cast("string"), blank).alias("role"),
                        F.coalesce(F.col(f"`{text}`").cast("string"), blank).alias("text"), F.lit(1).cast("long").alias("times"))
    kind = plain.schema["conv"].dataType.simpleString()
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role"]
    dealt = map_batches(plain, _counted, plain.schema).repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    schema = _struct(f"conv {kind}, {ROWS}, {RESULT}, repaired {REPAIRED}")
    numbered = dealt.withColumn("at", F.monotonically_increasing_id())
    parted = written(map_batches(numbered, _parted(schema, segment_rows, segment_bytes), schema), "conversations")
    whole = parted.where(F.col("at").isNull())

    # Conversations at the edges of tasks, or long ones: segments.
    cut = parted.where(F.col("at").isNotNull()).select("conv", *(n for n in COLUMNS if n != "conv"), "part")
    alike = cut.groupBy("conv", "role", F.sha2("text", 256).alias("digest")).agg(F.min("at").alias("at"))
    known = cut.join(alike.select("at", F.lit(False).alias("known")), "at", "left").na.fill(True, ["known"])
    known = written(known, "conversation-rows")
    by_segment = known.repartition("conv", "part").sortWithinPartitions("conv", "part", "at")
    tables = _struct(f"conv {kind}, part bigint, {', '.join(f'{c} bigint' for c in COUNTS)}, {EDGES}, {LINKS}")
    tops = _struct(f"conv {kind}, part bigint, entry bigint, exit bigint, end string, gaps bigint, {', '.join(f'{c} bigint' for c in COUNTS)}, cost bigint")
    between = written(map_batches(by_segment, _tables(tables), tables).groupBy("conv").applyInPandas(joined, tops), "conversation-tops")
    # Each side has a segment's rows together; a segment is bounded, whatever its conversation.
    told = known.withColumn("of", F.struct("conv", "part")).join(
        between.select(F.struct("conv", "part").alias("of"), "entry", "exit", "end"), "of").drop("of")
    again = told.repartition("conv", "part").sortWithinPartitions("conv", "part", "at")
    edited = _struct(f"conv {kind}, part bigint, piece bigint, audit string, repaired {REPAIRED}")
    pieces = written(map_batches(again, _edited(edited), edited), "conversation-pieces")
    audits = pieces.where(F.col("audit").isNotNull()).groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "audit"))).alias("a"))
    audits = audits.select("conv", F.array_join(F.transform("a", lambda x: x["audit"]), "").alias("audit"))
    result = ["gaps", *COUNTS, "cost"]
    per_conv = between.groupBy("conv").agg(*(F.max(c).alias(c) for c in result))
    report = per_conv.join(audits.withColumnRenamed("conv", "of"), F.col("conv").eqNullSafe(F.col("of"))).select("conv", *result, "audit")
    report = whole.select("conv", *result, "audit").unionByName(report)
    parts = whole.where(F.size("repaired") > 0).select("conv", F.lit(0).cast("long").alias("piece"), F.lit(True).alias("whole"), "repaired")
    more = pieces.where(F.col("repaired").isNotNull()).select("conv", "piece", F.lit(False).alias("whole"), "repaired")
    return Repaired(report.withColumnRenamed("conv", conv), parts.unionByName(more).withColumnRenamed("conv", conv))
