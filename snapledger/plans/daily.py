"""End-to-end daily runs over a storage root: bronze -> silver -> gold.

Layout under ``root`` (all Parquet):

- ``bronze/<entity>``        append-only, partitioned by transaction_date
- ``bronze_rejects/<entity>`` rows failing the bronze rules
- ``silver/<entity>``        dedup history + is_current_record, by transaction_date
- ``silver_key_index/<entity>`` key ranges and Bloom filters of each silver partition
- ``silver_states/<entity>`` (``states``) validity intervals, by the months of their ends
- ``silver_changes/<entity>`` (``changes``) what merges have replaced since the last restatement
- ``gold/ledger``            one immutable photo per snapshot_date (partitioned by it)
- ``gold/gmv_daily_by_subsidiary``, ``gold/quarantine_missing_items``,
  ``gold/dq_gmv_run_metrics``  one partition per snapshot_date
- ``gold/gmv_restated``      exact sums of chosen days as they are known now
- ``staging/<step>``         what a step writes in between; gone when it has ended

A step over many rows makes several passes, each over the purchases of one hash
slice, so that its shuffles take a part of the tables' disk and not a multiple of it.

Each step is idempotent: re-running a day replaces exactly that day's
partitions; silver re-processing is absorbed by deduplication.

Bronze and silver are partitioned by event day (``event_partition="day"``,
right when a day holds many files' worth of events) or by event month
(``"month"``, a derived ``transaction_month`` column, for tables whose days
hold only a few rows: thousands of tiny day directories cost more in file
listing and commits than they save in pruning).
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions.columns import as_date, ntz, session_clock
from snapledger.model import (
    DAYS_SCHEMA, DQ_SCHEMA, ENTITIES, LEDGER_SCHEMA, MARK_SCHEMA, MART_SCHEMA, PRODUCT_ITEM, PURCHASE, QUARANTINE_SCHEMA, RESTATED_SCHEMA, Entity)
from snapledger.operators import asof, backfill, bronze, gold, keyindex, quality, silver, states
from snapledger.sources import storage


@dataclass(frozen=True)
class Lake:
    root: str
    event_partition: str = "day"
    #: ("snapshot_date", "transaction_date") gives a folder per event day inside each photo.
    ledger_partition: tuple[str, ...] = ("snapshot_date",)
    #: Keep validity intervals beside silver, so the state of a day is a pruned scan.
    states: bool = False
    #: Keep what silver merges replace, so stored days can be restated (see :func:`restate`).
    changes: bool = False

    @property
    def event_part_col(self) -> str:
        return {"day": "transaction_date", "month": "transaction_month"}[self.event_partition]

    def with_event_part(self, df: DataFrame) -> DataFrame:
        if self.event_partition == "day":
            return df
        return df.withColumn("transaction_month", F.trunc("transaction_date", "month"))

    def read_events(
        self, spark: SparkSession, path: str, schema, upto: dt.date | None = None, with_part: bool = False
    ) -> DataFrame | None:
        """Typed read of a bronze/silver table; ``upto`` prunes partitions after that day;
        ``with_part`` keeps the partition column."""
        if self.event_partition == "day":
            df = storage.read_table(spark, path, schema)
            if df is not None and upto is not None:
                df = df.filter(F.col("transaction_date") <= F.lit(upto))
            return df
        df = storage.read_table(spark, path, T.StructType([*schema.fields, T.StructField("transaction_month", T.DateType())]))
        if df is None:
            return None
        if upto is not None:
            df = df.filter(F.col("transaction_month") <= F.trunc(F.lit(upto), "month"))
        return df if with_part else df.drop("transaction_month")

    def bronze(self, e: Entity) -> str:
        return f"{self.root}/bronze/{e.name}"

    def rejects(self, e: Entity) -> str:
        return f"{self.root}/bronze_rejects/{e.name}"

    def silver(self, e: Entity) -> str:
        return f"{self.root}/silver/{e.name}"

    def mark(self, e: Entity) -> str:
        """One row: the newest delivery folded into silver, written after the commit."""
        return f"{self.root}/silver_marks/{e.name}"

    def pending(self, e: Entity) -> str:
        """A folder that is there while silver partitions are being replaced."""
        return f"{self.root}/silver_pending/{e.name}"

    def index(self, e: Entity) -> str:
        # Not silver_index: filters there have bits in other places, and are made anew here.
        return f"{self.root}/silver_key_index/{e.name}"

    def stored_states(self, e: Entity) -> str:
        return f"{self.root}/silver_states/{e.name}"

    def change_log(self, e: Entity) -> str:
        return f"{self.root}/silver_changes/{e.name}"

    @property
    def restated(self) -> str:
        return f"{self.root}/gold/gmv_restated"

    @property
    def restated_days(self) -> str:
        return f"{self.root}/gold/gmv_restated_days"

    @property
    def restated_pending(self) -> str:
        """A folder that is there while restated days are replaced, or can't be restated from the changes."""
        return f"{self.root}/gold/gmv_restated_pending"

    @property
    def gold_pending(self) -> str:
        """Has a folder for each day whose gold tables are being replaced."""
        return f"{self.root}/gold_pending"

    @property
    def ledger(self) -> str:
        return f"{self.root}/gold/ledger"

    @property
    def mart(self) -> str:
        return f"{self.root}/gold/gmv_daily_by_subsidiary"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/gold/quarantine_missing_items"

    @property
    def dq(self) -> str:
        return f"{self.root}/gold/dq_gmv_run_metrics"


# ------------------------------------------------------------------ steps over many rows


Done = TypeVar("Done")

#: Rows that one pass shuffles, and passes over them at most (each reads the tables again).
#: FEW are enough where little but the pass itself is on disk.
SLICE_ROWS, MAX_SLICES, FEW = 2_000_000, 4, 2
SLICE_SEED = 2  # the key index hashes with 0 and 1


def _slices(*tables: DataFrame, most: int = MAX_SLICES) -> int:
    """Passes for the rows of stored tables (their files' footers tell how many)."""
    return max(1, min(most, -(-sum(t.count() for t in tables) // SLICE_ROWS)))


def _slice(df: DataFrame, k: int, of: int) -> DataFrame:
    """The rows of the purchases of one of ``of`` slices."""
    return df if of == 1 else df.where(F.pmod(F.xxhash64("purchase_id", F.lit(SLICE_SEED)), F.lit(of)) == k)


@contextmanager
def _staging(spark: SparkSession, lake: Lake, step: str) -> Iterator[str]:
    """A folder for what a step writes in between; also gone when a killed run has left it."""
    path = f"{lake.root}/staging/{step}"
    storage.remove(spark, path)
    try:
        yield path
    finally:
        storage.remove(spark, path)


def _releasing(step: Callable[..., Done]) -> Callable[..., Done]:
    """The step's shuffle files go with the actions that made them."""

    @functools.wraps(step)
    def run(spark: SparkSession, *args, **kwargs) -> Done:
        with storage.shuffles_released(spark):
            return step(spark, *args, **kwargs)

    return run


# ------------------------------------------------------------------ bronze


def ingest(lake: Lake, raw: DataFrame, entity: Entity, ingestion_at: dt.datetime | Column | None = None) -> None:
    """Type, stamp and append one delivery of events; invalid rows go to rejects.

    Without ``ingestion_at`` the delivery is stamped with one reading of the
    session's clock, so both writes (valid rows, rejects) carry the same stamp.
    """
    at = session_clock(raw.sparkSession) if ingestion_at is None else ingestion_at
    rows = bronze.stamp_ingestion(bronze.typed_events(raw, entity), at)
    valid, rejected = bronze.split_valid(rows, entity)
    with storage.shuffles_released(raw.sparkSession):
        storage.append(lake.with_event_part(valid), lake.bronze(entity), [lake.event_part_col])
        storage.append(rejected, lake.rejects(entity), [])


def read_bronze(spark: SparkSession, lake: Lake, entity: Entity) -> DataFrame:
    df = lake.read_events(spark, lake.bronze(entity), entity.bronze_schema)
    return df if df is not None else spark.createDataFrame([], entity.bronze_schema)


def arrived(spark: SparkSession, lake: Lake, entity: Entity, day: str | dt.date) -> bool:
    """Arrival gate: did bronze receive any event of ``day``?"""
    events = lake.read_events(spark, lake.bronze(entity), entity.bronze_schema)
    return events is not None and bronze.has_partition(events, day)


# ------------------------------------------------------------------ silver


#: Bronze deliveries up to this long before the mark are read again, so rows that
#: land late with an older stamp aren't lost; deduplication makes that harmless.
OVERLAP = dt.timedelta(days=1)


def read_mark(spark: SparkSession, lake: Lake, entity: Entity) -> dt.datetime | None:
    """The stored high-water mark; none (read everything) if it isn't there."""
    if not storage.exists(spark, lake.mark(entity)):
        return None
    row = storage.read_or_empty(spark, lake.mark(entity), MARK_SCHEMA).first()
    return row["mark"] if row else None


@_releasing
def run_silver(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    line_created_at: dt.datetime | None = None,
    overlap: dt.timedelta | None = OVERLAP,
) -> None:
    """Fold new bronze deliveries into silver, rewriting only touched partitions.

    First run: full build. Later runs: the increment after the high-water
    mark (minus ``overlap``) is merged for the business keys it touches. A run
    that was killed while it replaced partitions leaves its pending folder
    behind; the next run then rebuilds silver from all of bronze.
    """
    if storage.exists(spark, lake.pending(entity)):
        rebuild_silver(spark, lake, entity, line_created_at)
        return
    events = read_bronze(spark, lake, entity)
    mark = read_mark(spark, lake, entity)
    increment = silver.incremental_slice(events, mark, overlap)
    newest = increment.agg(F.max("ingestion_date").alias("m")).first()["m"]
    if newest is None:
        return
    current, held = lake.read_events(spark, lake.silver(entity), entity.silver_schema), None
    if mark is not None and overlap and current is not None:
        # Of the rows read again, those that silver holds as delivered touch nothing.
        held = current.where(F.col("bronze_ingestion_date") > ntz(mark - overlap))
    merge_into_silver(spark, lake, entity, increment, line_created_at, held)
    _write_mark(spark, lake, entity, newest)


@_releasing
def rebuild_silver(spark: SparkSession, lake: Lake, entity: Entity, line_created_at: dt.datetime | None = None) -> None:
    """Silver from all of bronze, replacing whatever is stored."""
    events = read_bronze(spark, lake, entity)
    newest = events.agg(F.max("ingestion_date").alias("m")).first()["m"]
    if newest is None:
        return
    with _staging(spark, lake, f"silver_{entity.name}") as staging:
        schema = _fold_into(lake, entity, _unstored(lake, entity, events, line_created_at), f"{staging}/silver", _slices(events, most=FEW))
        _replace_silver(spark, lake, entity, storage.read_or_empty(spark, f"{staging}/silver", schema))
    _write_beside(spark, lake, entity)
    _write_mark(spark, lake, entity, newest)


def _write_mark(spark: SparkSession, lake: Lake, entity: Entity, mark: dt.datetime) -> None:
    spark.range(1).select(ntz(mark).alias("mark")).coalesce(1).write.mode("overwrite").parquet(lake.mark(entity))


def read_index(spark: SparkSession, lake: Lake, entity: Entity) -> DataFrame:
    return storage.read_or_empty(spark, lake.index(entity), keyindex.index_schema(lake.event_part_col))


def read_states(spark: SparkSession, lake: Lake, entity: Entity) -> DataFrame:
    return storage.read_or_empty(spark, lake.stored_states(entity), states.states_schema(entity))


def silver_parts(spark: SparkSession, lake: Lake, entity: Entity, parts: list | None = None) -> DataFrame:
    """Stored silver with its partition column; only the named partitions if there are any named."""
    df = lake.read_events(spark, lake.silver(entity), entity.silver_schema, with_part=True)
    return df if parts is None else df.where(F.col(lake.event_part_col).isin(parts))


#: Runs of index rows that pile up before they are joined into one.
INDEX_RUNS = 32


def _write_index(spark: SparkSession, lake: Lake, entity: Entity, parts: list | None = None) -> None:
    """Index rows of the named silver partitions as a new run, or of all as the only one."""
    path, part = lake.index(entity), lake.event_part_col
    if parts is None:
        storage.remove(spark, path)
    rows = keyindex.partition_index(silver_parts(spark, lake, entity, parts), entity.business_key[0], part)
    storage.write_run(rows, path, 1 + max(map(int, storage.folder_values(spark, path, "run")), default=0), [part])
    runs = storage.folder_values(spark, path, "run")
    if len(runs) > INDEX_RUNS:
        whole = storage.staged(keyindex.newest(read_index(spark, lake, entity), part).drop("run"))
        storage.remove(spark, path)
        storage.write_run(whole, path, 1, [part])


def partitions_with(spark: SparkSession, lake: Lake, entity: Entity, keys: DataFrame) -> list:
    """Silver partitions that may hold the lead keys of ``keys``, from the index alone."""
    if not storage.exists(spark, lake.index(entity)):  # a lake written before there was an index
        _write_index(spark, lake, entity)
    lead = keys.select(F.col(entity.business_key[0]).alias("key")).distinct()
    return keyindex.partitions_with(read_index(spark, lake, entity), lead, lake.event_part_col)


def _replace_silver(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    out: DataFrame,
    parts: list | None = None,
    before: DataFrame | None = None,
) -> None:
    """Write silver partitions; :func:`_write_beside` has to follow.

    ``out`` is staged by partitions, of which ``parts`` are all, ``before`` the rows
    replaced: without them all of silver is new, and stored days can only be restated
    in full. Several partitions are replaced at a time, so that few are there twice.
    A kill before what is kept beside silver is written leaves the pending folder.
    """
    storage.make_folder(spark, lake.pending(entity))
    part = lake.event_part_col
    if before is not None:
        runs = storage.folder_values(spark, lake.change_log(entity), "run")
        storage.write_run(before, lake.change_log(entity), 1 + max(map(int, runs), default=0), list(entity.business_key))
    elif lake.changes and storage.exists(spark, lake.restated_days):
        storage.make_folder(spark, lake.restated_pending)
    every = parts if parts is not None else sorted(r[0] for r in out.select(part).distinct().collect())
    n = min(_slices(out), len(every))
    for k in range(n):
        storage.replace_partitions(out.where(F.col(part).isin(every[k::n])), lake.silver(entity), [part], balanced=True)


def _write_beside(
    spark: SparkSession, lake: Lake, entity: Entity, parts: list | None = None, versions: tuple[DataFrame, list] | None = None
) -> None:
    """Index and states of silver as it is now; that ends a replacement.

    ``parts`` are the partitions replaced, ``versions`` the new rows of the state
    partitions that the second item names; without them both are made anew.
    """
    _write_index(spark, lake, entity, parts)
    if versions is not None:
        storage.replace_partitions(versions[0], lake.stored_states(entity), states.STATE_PARTS, versions[1])
    elif lake.states:
        storage.remove(spark, lake.stored_states(entity))
        whole = states.states_of(silver_parts(spark, lake, entity), entity)
        storage.replace_partitions(whole, lake.stored_states(entity), states.STATE_PARTS)
    storage.remove(spark, lake.pending(entity))


def _unstored(lake: Lake, entity: Entity, increment: DataFrame, line_created_at: dt.datetime | None) -> DataFrame:
    """Prepared rows of an increment, as :func:`silver.fold` takes them."""
    ready = lake.with_event_part(silver.prepare_increment(increment, entity, line_created_at))
    return ready.withColumns({"_stored": F.lit(False), "_was": F.lit(None).cast("boolean")})


#: What :func:`silver.fold` tells of a row besides its flag.
MARKS = ("_stored", "_was", "_touched", "_kept", "_fresh")


def _fold_into(lake: Lake, entity: Entity, rows: DataFrame, path: str, slices: int, replaced: bool = False) -> T.StructType:
    """Write merged silver rows by partitions to a new table, slice by slice; with ``replaced``
    also the stored rows that silver no longer holds, and what marks them."""
    cols = list(dict.fromkeys([*entity.silver_columns, "line_created_at", silver.FLAG, lake.event_part_col, *(MARKS if replaced else ())]))
    heavy = silver.heavy_keys(rows, entity)
    for k in range(slices):
        out = silver.fold(_slice(rows, k, slices), entity, heavy)
        out = (out if replaced else out.where("_kept")).select(*cols)
        if k == 0:
            storage.replace_partitions(out, path, [lake.event_part_col])
        else:
            storage.append(out, path, [lake.event_part_col])
    return out.schema


def _log_schema(entity: Entity) -> T.StructType:
    return T.StructType([*entity.silver_schema.fields, T.StructField("run", T.IntegerType())])


@_releasing
def merge_into_silver(
    spark: SparkSession,
    lake: Lake,
    entity: Entity,
    increment: DataFrame,
    line_created_at: dt.datetime | None = None,
    held: DataFrame | None = None,
) -> None:
    """Merge bronze rows into silver (batch runs and stream micro-batches alike).

    The index names the partitions that may hold the increment's keys, and their
    key columns those that do; only these are read whole and replaced, in passes
    in which rows of other keys keep their flag. No other partition is opened.
    Increment rows that ``held`` (rows of silver) has as delivered are left out.
    """
    part, key = lake.event_part_col, list(entity.business_key)
    with _staging(spark, lake, f"silver_{entity.name}") as staging:
        if lake.read_events(spark, lake.silver(entity), entity.silver_schema) is None:
            # Nothing to be replaced: the passes write to silver itself.
            storage.make_folder(spark, lake.pending(entity))
            if lake.changes and storage.exists(spark, lake.restated_days):
                storage.make_folder(spark, lake.restated_pending)
            _fold_into(lake, entity, _unstored(lake, entity, increment, line_created_at), lake.silver(entity), _slices(increment, most=FEW))
            _write_beside(spark, lake, entity)
            return
        passes = _slices(increment, held, most=FEW) if held is not None else 1
        for k in range(passes):
            new = _slice(increment, k, passes)
            new = new if held is None else silver.not_held(new, _slice(held, k, passes), entity)
            _unstored(lake, entity, new, line_created_at).write.mode("append").parquet(f"{staging}/ready")
        ready = spark.read.schema(_unstored(lake, entity, increment, line_created_at).schema).parquet(f"{staging}/ready")
        keys = ready.select(*key).distinct()
        near = silver_parts(spark, lake, entity, partitions_with(spark, lake, entity, keys))
        # One value per touched partition reaches the driver.
        days = [r[0] for r in near.select(*key, part).join(keys, key, "left_semi").select(part).union(ready.select(part)).distinct().collect()]
        if not days:
            return
        stored = silver_parts(spark, lake, entity, days).withColumnRenamed(silver.FLAG, "_was").withColumn("_stored", F.lit(True))
        rows = stored.unionByName(ready)
        # The rewrite reads the table it replaces: stage it first.
        schema = _fold_into(lake, entity, rows, f"{staging}/silver", _slices(stored, ready), lake.states or lake.changes)
        whole = storage.read_or_empty(spark, f"{staging}/silver", schema)
        out, old, versions, before = whole, None, None, None
        if lake.states or lake.changes:
            names = entity.silver_schema.names
            out = whole.where("_kept").drop(*MARKS)
            old = whole.where(F.col("_stored") & F.col("_touched")).withColumn(silver.FLAG, F.col("_was")).select(*names)
            if lake.changes:
                # A key without stored rows is logged too, with nothing but itself.
                none = whole.where("_fresh").select(*(F.col(f.name) if f.name in key else F.lit(None).cast(f.dataType).alias(f.name) for f in entity.silver_schema.fields))
                before = old.unionByName(none)
            if lake.states:
                versions = _new_versions(spark, lake, entity, old, whole.where(F.col("_kept") & F.col("_touched")).drop(*MARKS), keys, staging)
        _replace_silver(spark, lake, entity, out, days, before)
        for done in ("ready", "silver"):
            storage.remove(spark, f"{staging}/{done}")
        _write_beside(spark, lake, entity, days, versions)


def _new_versions(
    spark: SparkSession, lake: Lake, entity: Entity, old: DataFrame, new: DataFrame, keys: DataFrame, staging: str
) -> tuple[DataFrame, list]:
    """The state partitions that touched keys leave or enter, with their new rows.

    The keys' rows before the merge tell which partitions hold their intervals now.
    """
    fresh = storage.shelved(states.states_of(new, entity), f"{staging}/fresh")
    months = sorted({*states.months_of(states.states_of(old, entity)), *states.months_of(fresh)})
    kept = states.in_months(read_states(spark, lake, entity), months).join(keys, list(entity.business_key), "left_anti")
    names = states.states_schema(entity).names
    return storage.shelved(kept.select(*names).unionByName(fresh), f"{staging}/versions"), months


# ------------------------------------------------------------------ gold


def read_silver(spark: SparkSession, lake: Lake, entity: Entity, upto: dt.date | None = None) -> DataFrame:
    df = lake.read_events(spark, lake.silver(entity), entity.silver_schema, upto)
    return df if df is not None else spark.createDataFrame([], entity.silver_schema)


def snapshot(
    spark: SparkSession,
    lake: Lake,
    snapshot_date: str | dt.date,
    snapshot_datetime: dt.datetime | None = None,
    grain: str = "item",
    part: tuple[int, int] = (0, 1),
) -> DataFrame:
    """The day's photo of paid purchases, from stored silver (not yet written); of
    those in one slice, if ``part`` names one and how many there are."""
    day = as_date(snapshot_date)
    if lake.states:
        state = {n: states.as_of_states(_slice(read_states(spark, lake, e), *part), e, day) for n, e in ENTITIES.items()}
        events = None  # hot purchases are counted on the state itself: a column of a pruned scan
    else:
        rows = {n: _slice(read_silver(spark, lake, e, upto=day), *part) for n, e in ENTITIES.items()}
        state = {n: asof.as_of(rows[n], e, day) for n, e in ENTITIES.items()}
        events = rows["product_item"]
    p, i, x = state["purchase"], state["product_item"], state["purchase_extra_info"]
    return gold.purchase_snapshot(p, i, x, day, snapshot_datetime, grain=grain, item_events=events)


def yesterday(spark: SparkSession) -> dt.date:
    """Default snapshot day of a daily run: D-1 by the session's clock."""
    return session_clock(spark).date() - dt.timedelta(days=1)


@_releasing
def run_gold(
    spark: SparkSession,
    lake: Lake,
    snapshot_date: str | dt.date | None = None,
    snapshot_datetime: dt.datetime | None = None,
    grain: str = "item",
) -> None:
    """Write the day's ledger photo, then its mart, quarantine and DQ partitions.

    A rerun replaces the whole day, also when its new result is empty; every
    run leaves one metrics row. Later outputs are computed from the photo as written (re-read), never
    from a lazy plan that would re-evaluate clocks or read replaced files. A run killed between
    the four writes leaves its day's pending folder; the next run, of whatever day, runs that day first.
    """
    day = as_date(snapshot_date) if snapshot_date is not None else yesterday(spark)
    stamp = snapshot_datetime or session_clock(spark).replace(microsecond=0)
    for left in unfinished_days(spark, lake):
        if left != day:
            _write_gold(spark, lake, left, stamp, grain)
    _write_gold(spark, lake, day, stamp, grain)


def unfinished_days(spark: SparkSession, lake: Lake) -> list[dt.date]:
    """Days whose gold tables may come from different runs, ascending."""
    return [as_date(d) for d in storage.folder_values(spark, lake.gold_pending, "snapshot_date")]


def _write_gold(spark: SparkSession, lake: Lake, day: dt.date, stamp: dt.datetime, grain: str) -> None:
    pending = f"{lake.gold_pending}/snapshot_date={day}"
    storage.make_folder(spark, pending)
    n = _slices(read_silver(spark, lake, PURCHASE, upto=day), read_silver(spark, lake, PRODUCT_ITEM, upto=day), most=FEW)
    with _staging(spark, lake, "photo") as staging:
        photo = snapshot(spark, lake, day, stamp, grain)
        for k in range(n if n > 1 else 0):
            storage.append(snapshot(spark, lake, day, stamp, grain, (k, n)), staging, lake.ledger_partition)
        if n > 1:
            photo = storage.read_or_empty(spark, staging, LEDGER_SCHEMA)
        storage.replace_partitions(photo, lake.ledger, lake.ledger_partition, [day], ["transaction_date"], balanced=n > 1)
    written = read_ledger(spark, lake).filter(F.col("snapshot_date") == F.lit(day))
    storage.replace_partitions(gold.gmv_by_subsidiary(written), lake.mart, ["snapshot_date"], [day])
    storage.replace_partitions(quality.quarantine_missing_items(written), lake.quarantine, ["snapshot_date"], [day])
    metrics = quality.dq_run_row(quality.dq_metrics(written), day, stamp)
    storage.replace_partitions(metrics, lake.dq, ["snapshot_date"], [day])
    storage.remove(spark, pending)


# ------------------------------------------------------------------ restated days


@_releasing
def restate(spark: SparkSession, lake: Lake, days: list[str | dt.date] | None = None) -> list[dt.date]:
    """Bring the restated mart (``lake.changes``) up to what silver holds now.

    The photos of the ledger and the published mart of a day never change; this
    table has the same days as late events have altered them. ``days`` are added to
    those it keeps. Purchases that merges have touched since the last call are the
    only ones looked at: their old contributions (from the rows that were replaced)
    are taken off the stored sums and the new ones added, and only days that this
    alters are rewritten. Returns these days. A killed call, or a silver that was
    built anew, is followed by a full computation.
    """
    if not lake.changes:
        raise ValueError("this lake keeps no changes: open it with changes=True")
    kept = {r[0] for r in storage.read_or_empty(spark, lake.restated_days, DAYS_SCHEMA).collect()}
    wanted = {as_date(d) for d in days or ()}
    altered: set[dt.date] = set()
    with _staging(spark, lake, "restated") as staging:
        if storage.exists(spark, lake.restated_pending):
            fresh = kept | wanted
        else:
            fresh = wanted - kept
            changes = _sum_changes(spark, lake, sorted(kept), staging)
            storage.make_folder(spark, lake.restated_pending)
            if changes is not None:
                altered = {r[0] for r in changes.select("snapshot_date").distinct().collect()}
            if altered:
                stored = read_restated(spark, lake).where(F.col("snapshot_date").isin(sorted(altered)))
                out = storage.shelved(backfill.restated_sums(stored, changes), f"{staging}/restated")
                storage.replace_partitions(out, lake.restated, ["snapshot_date"], sorted(altered))
        if fresh:
            rows, sums = [read_silver(spark, lake, e) for e in ENTITIES.values()], f"{staging}/fresh"
            n = _slices(*rows)
            for k in range(n):
                _add_sums(backfill.sums_of_days(*(_slice(r, k, n) for r in rows), sorted(fresh)), sums)
            storage.replace_partitions(backfill.added(_read_sums(spark, sums)), lake.restated, ["snapshot_date"], sorted(fresh))
    for e in ENTITIES.values():
        storage.remove(spark, lake.change_log(e))
    listed = spark.createDataFrame([(d,) for d in sorted(kept | wanted)], DAYS_SCHEMA).coalesce(1)
    listed.write.mode("overwrite").parquet(lake.restated_days)
    storage.remove(spark, lake.restated_pending)
    return sorted(altered | fresh)


def _add_sums(sums: DataFrame, path: str) -> None:
    """Sums of one slice, beside those of others: a purchase adds to its groups whatever others do."""
    sums.write.mode("append").parquet(path)


def _read_sums(spark: SparkSession, path: str) -> DataFrame:
    return storage.read_or_empty(spark, path, RESTATED_SCHEMA)


def _sum_changes(spark: SparkSession, lake: Lake, days: list[dt.date], staging: str) -> DataFrame | None:
    """What logged merges change in the sums of ``days``; none without logs or days."""
    logs = {n: storage.read_table(spark, lake.change_log(e), _log_schema(e)) for n, e in ENTITIES.items()}
    touched = [log.select("purchase_id") for log in logs.values() if log is not None]
    if not touched or not days:
        return None
    purchases = touched[0]
    for t in touched[1:]:
        purchases = purchases.unionByName(t)
    purchases = storage.shelved(purchases.distinct(), f"{staging}/purchases")
    held = {}
    for n, e in ENTITIES.items():
        if lake.read_events(spark, lake.silver(e), e.silver_schema) is None:
            held[n] = spark.createDataFrame([], e.silver_schema)
        else:
            held[n] = silver_parts(spark, lake, e, partitions_with(spark, lake, e, purchases)).select(*e.silver_schema.names)
    passes = _slices(*held.values())
    for k in range(passes):
        now, old = [], []
        for n, e in ENTITIES.items():
            key = list(e.business_key)
            mine = _slice(held[n], k, passes).join(_slice(purchases, k, passes), "purchase_id", "left_semi")
            rows = storage.shelved(mine, f"{staging}/now/{n}")
            now.append(rows)
            if logs[n] is None:
                old.append(rows)
                continue
            # Of several merges of a key the first one replaced what the stored sums count.
            log = _slice(logs[n], k, passes)
            first = log.groupBy(*key).agg(F.min("run").alias("run"))
            before = log.join(first, [*key, "run"], "left_semi").where(F.col("transaction_datetime").isNotNull())
            was = rows.join(first, key, "left_anti").unionByName(before.select(*e.silver_schema.names))
            old.append(storage.shelved(was, f"{staging}/old/{n}"))
        _add_sums(backfill.sums_of_days(*now, days), f"{staging}/sums_now")
        _add_sums(backfill.sums_of_days(*old, days), f"{staging}/sums_old")
    changed = backfill.changed_sums(_read_sums(spark, f"{staging}/sums_now"), _read_sums(spark, f"{staging}/sums_old"))
    return storage.shelved(changed, f"{staging}/changes")


def read_restated(spark: SparkSession, lake: Lake) -> DataFrame:
    return storage.read_or_empty(spark, lake.restated, RESTATED_SCHEMA)


def restated_view(spark: SparkSession, lake: Lake) -> DataFrame:
    """The mart of the kept days as known now."""
    return backfill.mart_of_sums(read_restated(spark, lake))


# ------------------------------------------------------------------ published views


def read_mart(spark: SparkSession, lake: Lake) -> DataFrame:
    return storage.read_or_empty(spark, lake.mart, MART_SCHEMA)


def read_ledger(spark: SparkSession, lake: Lake) -> DataFrame:
    return storage.read_or_empty(spark, lake.ledger, LEDGER_SCHEMA)


def ledger_view(spark: SparkSession, lake: Lake) -> DataFrame:
    """The ledger with ``is_current_snapshot`` derived on read (no daily rewrite of old days)."""
    return gold.mark_current_snapshot(read_ledger(spark, lake))


def mart_view(spark: SparkSession, lake: Lake) -> DataFrame:
    """The published mart with ``is_current_snapshot`` and ``transaction_date`` derived on read."""
    return gold.mark_current_snapshot(read_mart(spark, lake)).withColumn("transaction_date", F.col("snapshot_date"))


def quarantine_view(spark: SparkSession, lake: Lake) -> DataFrame:
    return storage.read_or_empty(spark, lake.quarantine, QUARANTINE_SCHEMA)


def dq_view(spark: SparkSession, lake: Lake) -> DataFrame:
    return storage.read_or_empty(spark, lake.dq, DQ_SCHEMA)


def run_day(
    spark: SparkSession,
    lake: Lake,
    snapshot_date: str | dt.date,
    snapshot_datetime: dt.datetime | None = None,
    line_created_at: dt.datetime | None = None,
) -> None:
    """Silver for every entity, then gold for ``snapshot_date``."""
    for e in ENTITIES.values():
        run_silver(spark, lake, e, line_created_at=line_created_at)
    run_gold(spark, lake, snapshot_date, snapshot_datetime)
