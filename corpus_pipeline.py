"""The corpus pipeline: five stages from raw documents to encoded training text.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``;
all but the last return the columns of ``docs``. Null texts count as empty, null
and repeated ids are rows of their own, further columns go along whatever their
names, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.common import read_table, row_keyed, ship, written
from snapledger.llm.mixing import mix, words_cut
from snapledger.llm.pieces import encode_pieces
from snapledger.llm.quality import fit_on, graded, ratings
from snapledger.llm.simhash import simhash_components
from snapledger.llm.suffixes import remove_repeats

#: Probability of the top grade that a document must have.
LEAST_GOOD = 0.5


def with_text(docs: DataFrame, text: str, columns: list[str], own: dict[str, str]) -> DataFrame:
    """The columns of a table with a new text; ``n_chars`` follows it where there is one.

    ``own`` names the columns that hold the others now.
    """
    out = []
    for c in columns:
        if c == "text":
            out.append(F.col(text).alias(c))
        elif c == "n_chars":
            out.append(F.length(text).cast("long").alias(c))
        else:
            out.append(F.col(f"`{own.get(c, c)}`").alias(c))
    return docs.select(*out)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship(spark)
    model = fit_on(docs, ratings(read_table(spark, sf_dir, "labels")))
    return docs.where(graded(F.col("text"), model)["tail"] >= LEAST_GOOD)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays: the first by id."""
    rows, row = row_keyed(docs, "doc_id")
    groups = simhash_components(rows, key=row)
    first = groups.where(F.col(row) == F.col("component_id")).select(row)
    return rows.join(first, row, "left_semi").select(*(f"`{c}`" for c in docs.columns))


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that also start earlier are removed; a character cut in two goes with them."""
    cut = remove_repeats(docs, carry=docs.columns)
    return with_text(cut, "kept", docs.columns, {c: f"carry_{i}" for i, c in enumerate(docs.columns)})


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources reach their target shares: a document is repeated as a whole as often
    as its shard's quota says, and its words in blocks taken once more make one row more."""
    rows, row = row_keyed(docs, "doc_id")
    named = {c: f"carry_{i}" for i, c in enumerate(docs.columns)}
    rows = rows.select(F.col(row).alias("at"), *(F.col(f"`{c}`").alias(a) for c, a in named.items()))
    quotas = mix(rows, key="at", source=named["source"], text=named["text"], with_spans=True).select("at", "times", "spans")
    told = rows.join(quotas, "at")
    text = F.coalesce(F.col(named["text"]).cast("string"), F.lit(""))
    told = told.withColumn("part", words_cut(text, F.col("spans")))
    copies = F.concat(F.array_repeat(text, F.col("times").cast("int")), F.when(F.size("spans") > 0, F.array("part")).otherwise(F.array().cast("array<string>")))
    return with_text(told.withColumn("mixed", F.explode(copies)), "mixed", docs.columns, named)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every text, with digests of the ids and of the text decoded from them."""
    return encode_pieces(docs).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: No stage list of this kind can be written as one SQL statement (a trained
#: classifier, near-duplicate components, a seeded selection, a tokenizer), so
#: the stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``STAGES`` applied to ``documents``, each result written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
