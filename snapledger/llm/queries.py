"""The registered ``opN_<name>`` queries: thin digests over the operators.

Each query applies its operator, with production parameters, to its whole
table and returns the full result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.common import map_batches, read_table
from snapledger.llm.conversations import repair_conversations
from snapledger.llm.damage import damaged_conversations, repeating_texts
from snapledger.llm.fingerprints import neighbour_fingerprints
from snapledger.llm.html_text import main_texts
from snapledger.llm.mixing import mix
from snapledger.llm.neighbours import vector_links
from snapledger.llm.oracle import QUALITY_RULES
from snapledger.llm.periods import periodic_runs
from snapledger.llm.pieces import encode_pieces
from snapledger.llm.quality import quality
from snapledger.llm.rules import quality_rules
from snapledger.llm.simhash import simhash_components
from snapledger.llm.suffixes import remove_repeats
from snapledger.llm.token_counts import token_counts
from snapledger.llm.token_files import token_files


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(read_table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), with_text=False)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(read_table(spark, sf_dir, "documents"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(read_table(spark, sf_dir, "documents"), with_ids=False)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read_table(spark, sf_dir, "pages"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links(read_table(spark, sf_dir, "embeddings"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest run of every document, and digests of all its runs and of its collapsed text."""
    found = periodic_runs(repeating_texts(read_table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    digest = lambda c: F.sha2(c, 256)
    told = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"),
                        digest(F.array_join(lines, "")).alias("runs_sha256"), digest("collapsed").alias("collapsed_sha256"))
    return told.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
                       F.expr("1000 * best.length div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def _running_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sha256 per conversation over the lines of its sorted pieces."""
    now, h = None, None
    for b in batches:
        for conv, lines in zip(b.column("conv_id").to_pylist(), b.column("lines").to_pylist()):
            if h is None or conv != now:
                if h is not None:
                    yield pa.RecordBatch.from_pydict({"conv_id": [now], "repaired_sha256": [h.hexdigest()]}, schema=pa.schema([b.schema.field("conv_id"), ("repaired_sha256", pa.string())]))
                now, h = conv, hashlib.sha256()
            else:
                h.update(b"\n")
            h.update(lines.encode())
    if h is not None:
        yield pa.RecordBatch.from_pydict({"conv_id": [now], "repaired_sha256": [h.hexdigest()]}, schema=pa.schema([b.schema.field("conv_id"), ("repaired_sha256", pa.string())]))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage, its cheapest repair and the digest of the repaired rows."""
    rows = read_table(spark, sf_dir, "conversations")
    done = repair_conversations(damaged_conversations(rows))
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    whole = done.pieces.where("whole").select("conv_id", F.sha2(lines, 256).alias("repaired_sha256"))
    # A conversation in several pieces is digested piece after piece.
    several = done.pieces.where(~F.col("whole")).select("conv_id", "piece", lines.alias("lines"))
    several = several.repartition("conv_id").sortWithinPartitions("conv_id", "piece").select("conv_id", "lines")
    kind = rows.schema["conv_id"].dataType.simpleString()
    digests = whole.unionByName(map_batches(several, _running_digests, f"conv_id {kind}, repaired_sha256 string"))
    out = rows.select("conv_id").distinct()
    for other in (done.report, digests):
        other = other.withColumnRenamed("conv_id", "of")
        out = out.join(other, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document, the base rule and the verdict of the certified cutoffs."""
    out = quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (
        op1_token_counts, op2_quality, op3_source_mix, op4_fingerprints, op5_suffix_dedup, op6_token_files, op7_pieces, op8_simhash,
        op9_html_text, op10_embedding_dedup, op11_periodic_runs, op12_conversation_repair, op13_quality_rules)
}

#: DuckDB SQL where SQL can express the operator.
ORACLE: dict[str, str] = {"op13_quality_rules": QUALITY_RULES}
