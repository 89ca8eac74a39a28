"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one key that one task is meant to join; tunable per session. A key
# with more is split into as many parts as its own row count asks for.
KEY_ROWS_CONF = "snapledger.skew.keyRows"
KEY_ROWS = 2_000_000


def rows_of_one_task(spark: SparkSession) -> int:
    return int(spark.conf.get(KEY_ROWS_CONF, str(KEY_ROWS)))


def part_of_row(columns: Sequence[str]) -> Column:
    """The part of a row whose key has ``_parts`` parts (none: one part), by a hash of the whole row."""
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    return F.when(parts > 1, F.pmod(F.xxhash64(*[F.col(c) for c in columns]), parts)).otherwise(0).cast("int")


def hot_keys(df: DataFrame, keys: Sequence[str], key_rows: int) -> DataFrame:
    """Keys with more than ``key_rows`` rows, and the parts each is split into.

    A partially aggregated count; at most rows / ``key_rows`` keys come out.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > key_rows)
    return counted.select(*keys, F.ceil(F.col("_n") / key_rows).cast("int").alias("_parts"))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot_on: Sequence[str] | None = None,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """``big`` join ``small`` on ``keys``, where ``small`` has at most one row per key.

    One plan without a job while it is built: the hot keys with their part
    counts (at most rows / ``key_rows`` rows of two numbers, hence broadcast)
    give every ``big`` row of a hot key a part by a hash of the whole row
    (deterministic, so retries agree), and every ``small`` row of a hot key one
    copy per part. Other keys have the one part 0. Each ``big`` row meets its
    ``small`` row exactly once. ``how`` is "inner" or "left" (``big`` preserved).

    ``hot_on`` (a prefix of ``keys``) and ``key_source`` let the hot keys be
    counted on a cheaper input whose row count per key bounds that of ``big``
    (e.g. the raw events behind an as-of state): splitting a key that turns
    out not to be hot is harmless.
    """
    key_rows = rows_of_one_task(big.sparkSession)
    on = list(hot_on or keys)
    hot = F.broadcast(hot_keys((key_source if key_source is not None else big).select(*on), on, key_rows))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    spread = big.join(hot, on, "left").withColumn("_part", part_of_row(big.columns))
    copies = small.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    # ``small`` may come hash-partitioned on the keys alone; joining in that layout
    # would bring the parts together again, so it is dealt by key and part.
    dealt = copies.drop("_parts").repartition(*keys, "_part")
    return spread.drop("_parts").join(dealt, [*keys, "_part"], how).drop("_part")
