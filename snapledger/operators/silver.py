"""Silver layer: deduplicated event history with a current-record flag.

Pipeline per entity (all lazy DataFrame steps):
high-water mark -> increment -> prepare -> union with history -> dedup events
-> flag the current record per business key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.functions.columns import desc_order, latest_per_key, ntz, stamp, status_from_release
from snapledger.functions.skew import part_of_row, rows_of_one_task, salted_join
from snapledger.model import Entity

FLAG = "is_current_record"


def high_water_mark(silver: DataFrame | None) -> dt.datetime | None:
    """Newest bronze delivery already folded into silver (one scalar to the driver)."""
    if silver is None:
        return None
    return silver.agg(F.max("bronze_ingestion_date").alias("m")).first()["m"]


def incremental_slice(
    bronze: DataFrame, mark: dt.datetime | None, overlap: dt.timedelta | None = None
) -> DataFrame:
    """Bronze rows delivered after ``mark`` (all rows when there is no mark).

    ``overlap`` re-reads a window before the mark so rows that land late with
    an older delivery stamp are not lost; dedup makes the re-read harmless.
    """
    if mark is None:
        return bronze
    since = mark - overlap if overlap else mark
    return bronze.filter(F.col("ingestion_date") > ntz(since))


def not_held(increment: DataFrame, silver: DataFrame, entity: Entity) -> DataFrame:
    """Bronze rows that silver doesn't hold exactly as delivered.

    Every bronze column is compared, the payload too: a redelivery with the stamp of
    the first one but other values has to reach deduplication.
    """
    held = silver.select(*(F.col("bronze_ingestion_date" if c == "ingestion_date" else c).alias(f"_held_{c}") for c in increment.columns))
    same = F.lit(True)
    for c in increment.columns:
        same = same & increment[c].eqNullSafe(held[f"_held_{c}"])
    return increment.join(held, same, "left_anti")


def prepare_increment(
    increment: DataFrame, entity: Entity, line_created_at: Column | dt.datetime | None = None
) -> DataFrame:
    """Derive status (purchases), stamp lineage, rename the delivery column."""
    out = increment
    if entity.has_status:
        out = out.withColumn("transaction_status", status_from_release("release_date"))
    return out.withColumn("line_created_at", stamp(line_created_at)).withColumnRenamed("ingestion_date", "bronze_ingestion_date")


def union_history(history: DataFrame | None, increment: DataFrame) -> DataFrame:
    """History ∪ increment by column name; columns missing on one side become NULL.

    The current flag is dropped from history first: it is recomputed.
    """
    if history is None:
        return increment
    return history.drop(FLAG).unionByName(increment, allowMissingColumns=True)


def _tie_break(df: DataFrame, entity: Entity, first: Sequence[str]) -> list[Column]:
    rest = [c for c in entity.payload if c in df.columns and c not in first]
    if "transaction_status" in df.columns and "transaction_status" not in first:
        rest.append("transaction_status")
    order = desc_order([*first, *rest])
    if "line_created_at" in df.columns:
        # Full ties (a re-read row): keep the row that was created first.
        order.append(F.col("line_created_at").asc_nulls_last())
    return order


def dedup_events(df: DataFrame, entity: Entity, delivery_col: str = "bronze_ingestion_date") -> DataFrame:
    """One row per event key: the newest delivery wins.

    The order is total (newest delivery, then every payload column), so the
    survivor is deterministic even for redeliveries stamped at the same time.
    """
    return latest_per_key(df, entity.event_key, _tie_break(df, entity, [delivery_col]))


def mark_current(df: DataFrame, entity: Entity, flag: str = FLAG, key_source: DataFrame | None = None) -> DataFrame:
    """Flag the latest event per business key, keeping every row.

    The latest event time and the number of rows per key come from one partially
    aggregated pass (a hot key shrinks to one value per map task). Keys with so many
    rows that one task shouldn't join them get their latest time from a broadcast (at
    most rows / ``key_rows`` of them) and their rows are spread over several tasks; the
    other keys are joined. Rows keep one event per (key, event time) after
    :func:`dedup_events`, so exactly one is current; rows with a null key are
    kept and never current. ``key_source`` (the rows before deduplication) is a
    cheaper input for the latest time and for finding hot keys.
    """
    key = list(entity.business_key)
    # Deduplication keeps every event time, so the rows before it have the same maximum.
    source = df if key_source is None else key_source
    most = rows_of_one_task(df.sparkSession)
    counted = source.groupBy(*key).agg(F.max("transaction_datetime").alias("_latest_dt"), F.count(F.lit(1)).alias("_n"))
    # Both sides use time and count, so that the shuffle of ``counted`` is made once.
    hot = counted.where(F.col("_n") > most).select(*key, F.col("_latest_dt").alias("_hot_dt"), F.ceil(F.col("_n") / most).cast("int").alias("_parts"))
    cold = counted.where(F.col("_n") <= most).select(*key, "_latest_dt", F.lit(0).alias("_part"))
    spread = df.join(F.broadcast(hot), key, "left").withColumn("_part", part_of_row(df.columns))
    return (
        spread.join(cold.repartition(*key, "_part"), [*key, "_part"], "left")
        .withColumn(flag, F.coalesce(F.col("transaction_datetime") == F.coalesce("_hot_dt", "_latest_dt"), F.lit(False)))
        .select(*[c for c in df.columns if c != flag], flag)
    )


#: Keys are counted by this many hash groups before any is counted alone.
COUNT_GROUPS = 1 << 16


def heavy_keys(rows: DataFrame, entity: Entity) -> DataFrame | None:
    """Business keys with so many rows that one task shouldn't rank them (at most rows / ``key_rows``).

    They come with their latest event time and whether all or any of their rows are
    ``_stored``. Runs a job of a few numbers per task: only keys of hash groups with
    that many rows are counted one by one, so mostly none is.
    """
    key, most = list(entity.business_key), rows_of_one_task(rows.sparkSession)
    group = F.pmod(F.xxhash64(*key), F.lit(COUNT_GROUPS))
    full = rows.groupBy(group.alias("g")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).collect()
    if not full:
        return None
    counted = rows.where(group.isin([r["g"] for r in full])).groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), F.max("transaction_datetime").alias("_latest"),
        F.bool_and("_stored").alias("_all_stored"), F.bool_or("_stored").alias("_any_stored"))
    return counted.where(F.col("_n") > most).drop("_n")


def fold(rows: DataFrame, entity: Entity, heavy: DataFrame | None = None) -> DataFrame:
    """Which of ``rows`` the merged silver holds, from one shuffle and one sort of them.

    ``rows`` are prepared events of an increment (``_stored`` false) and stored ones
    (``_stored`` true, their flag as ``_was``). Out come those that silver holds now
    (``_kept``, with the flag) and all that were stored, as :func:`dedup_events` and
    :func:`mark_current` have them: of keys in the increment (``_touched``) the newest
    delivery of each event; rows of other keys stay as they are. ``_fresh`` marks the
    current row of a key without stored rows. Ranking a key's rows from the newest
    event on, the first row is the current one and a row with the time of the row before
    it is an older delivery. Rows of ``heavy`` keys are dealt by event instead.
    """
    key = list(entity.business_key)
    if set(entity.event_key) != {*key, "transaction_datetime"}:
        raise ValueError(f"events of {entity.name} aren't named by business key and time")
    ties, time = _tie_break(rows, entity, ["bronze_ingestion_date"]), F.col("transaction_datetime")
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in entity.event_key])
    each = Window.partitionBy(*key)
    ranked = each.orderBy(time.desc_nulls_last(), *ties)
    light = rows if heavy is None else rows.join(F.broadcast(heavy.select(*key)), key, "left_anti").select(*rows.columns)
    # In this order the sort of the first window serves the second too.
    seen = light.select("*", (F.row_number().over(ranked) == 1).alias("_first"), F.lag(time).over(ranked).eqNullSafe(time).alias("_again"))
    seen = seen.select("*", F.bool_and("_stored").over(each).alias("_all_stored"), F.bool_or("_stored").over(each).alias("_any_stored"))
    out = seen.withColumn("_newest", F.col("_first") | ~F.col("_again")).withColumn("_last", F.col("_first") & known)
    if heavy is not None:
        many = rows.join(F.broadcast(heavy), key)
        # Of the increment's deliveries of an event one is left before the shuffle; of stored ones there is one.
        few = many.where("_stored").unionByName(dedup_events(many.where("NOT _stored"), entity))
        event = Window.partitionBy(*entity.event_key).orderBy(*ties)
        ends = few.withColumn("_newest", F.row_number().over(event) == 1)
        ends = ends.withColumn("_last", F.coalesce(F.col("_newest") & (time == F.col("_latest")), F.lit(False)))
        names = [*rows.columns, "_newest", "_last", "_all_stored", "_any_stored"]
        out = out.select(*names).unionByName(ends.select(*names))
    out = out.withColumn("_touched", ~F.col("_all_stored"))
    return out.select(
        *(c for c in rows.columns if c != FLAG),
        "_touched",
        (~F.col("_touched") | F.col("_newest")).alias("_kept"),
        (F.col("_last") & ~F.col("_any_stored")).alias("_fresh"),
        F.when(F.col("_touched"), F.col("_last")).otherwise(F.col("_was")).alias(FLAG),
    ).where(F.col("_kept") | F.col("_stored"))


def enrich_from_current(
    df: DataFrame,
    purchase_silver: DataFrame,
    columns: Sequence[str] = ("prod_item_id", "prod_item_partition", "purchase_partition"),
    key_source: DataFrame | None = None,
) -> DataFrame:
    """Add partition-key columns from the current purchase record.

    Only columns that exist in the purchase silver and are absent from ``df``
    are added; with none of them available ``df`` is returned unchanged (an
    explicit check rather than a swallowed error). ``key_source`` (the rows before
    deduplication) is a cheaper input for finding hot purchases: without it ``df``
    is worked out twice.
    """
    wanted = [c for c in columns if c in purchase_silver.columns and c not in df.columns]
    if not wanted:
        return df
    current = purchase_silver.filter(F.col(FLAG)).select("purchase_id", *wanted)
    return salted_join(df, current, ["purchase_id"], "left", key_source=key_source)


def build_silver(
    bronze_increment: DataFrame,
    entity: Entity,
    history: DataFrame | None = None,
    line_created_at: Column | dt.datetime | None = None,
) -> DataFrame:
    """Full silver table = flag(dedup(history ∪ prepare(increment)))."""
    ready = prepare_increment(bronze_increment, entity, line_created_at)
    union = union_history(history, ready)
    flagged = mark_current(dedup_events(union, entity), entity, key_source=union)
    return flagged.select(*entity.silver_columns, "line_created_at", FLAG)


def merge_increment(
    silver: DataFrame,
    increment: DataFrame,
    entity: Entity,
    line_created_at: Column | dt.datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Upsert a bronze increment into silver, touching only affected keys.

    Returns ``(changed, unchanged)``: ``changed`` holds every row of the
    business keys present in the increment, re-deduplicated (newest delivery
    wins, also against older stored rows) and re-flagged; ``unchanged`` is
    the rest of silver, untouched. Their union is the new silver table.
    """
    key = list(entity.business_key)
    ready = prepare_increment(increment, entity, line_created_at)
    touched = ready.select(*key).distinct()
    history = silver.join(touched, key, "left_semi")
    unchanged = silver.join(touched, key, "left_anti")
    rows = union_history(history, ready)
    changed = mark_current(dedup_events(rows, entity), entity, key_source=rows)
    cols = [*entity.silver_columns, "line_created_at", FLAG]
    return changed.select(*cols), unchanged.select(*cols)


def upsert(silver: DataFrame, increment: DataFrame, entity: Entity,
           line_created_at: Column | dt.datetime | None = None) -> DataFrame:
    """MERGE-style upsert of ``increment`` into ``silver`` keyed by the event key."""
    changed, unchanged = merge_increment(silver, increment, entity, line_created_at)
    return unchanged.unionByName(changed)
