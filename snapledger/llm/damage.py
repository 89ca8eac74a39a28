"""Inputs of queries, made from the given tables by the rules their contracts state.

These give rows of the schema an operator expects and do none of its work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.rules import WORD, let


def repeating_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: texts of which every tenth (by the id's crc32) goes on periodically.

    With h the crc32 of the decimal id and g = floor(h / 10), each word from
    a = g % n on becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)).
    Texts without words, and rows without an id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def periodic(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")

        def from_there(tail: Column) -> Column:
            m = F.size(tail)
            p = 1 + F.floor(m / (3 + g % 8)).cast("int")
            copies = F.flatten(F.array_repeat(F.slice(tail, F.lit(1), p), F.ceil(m / p).cast("int")))
            return F.slice(copies, F.lit(1), m)

        return F.array_join(F.concat(F.slice(words, F.lit(1), a), let(F.slice(words, a + 1, n - a), from_there)), " ")

    text = F.col("text").cast("string")
    changed = let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.when(F.size(w) > 0, periodic(w)).otherwise(text))
    return docs.select("doc_id", F.when(h % 10 == 0, changed).otherwise(text).alias("text"))


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults by the crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes the text's full stops, exclamation
    and question marks, 3 repeats it, 4 makes it the user's. Nulls are one space.
    """
    blank = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *named)) % 20
    text = F.coalesce(F.col("text").cast("string"), blank)
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(F.col("role").cast("string"), blank))
    times = F.explode(F.array_repeat(F.lit(1), F.when(kind == 3, 2).otherwise(1)))
    return rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_")).drop("_")
