"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the star-schema tables under ``sf_dir`` in full and derives
its inputs from them (see :mod:`snapledger.sources.testmap`), so its work
grows with the data. Parameters below are fixed query parameters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import uuid

from snapledger.functions.columns import ntz
from snapledger.model import ENTITIES, EXTRA_INFO, PRODUCT_ITEM, PURCHASE, Entity
from snapledger.operators import asof, backfill, bronze, gold, quality, reports, silver, states
from snapledger.plans import daily, ddl
from snapledger.session import scratch_path
from snapledger.sources import storage, testmap
from snapledger.streaming.incremental import silver_stream

# Fixed query parameters.
REPORT_YEAR = 1997
TOP_N = 50
TOP_K = 2
ASOF_CUTOFF = dt.date(1998, 6, 30)
SNAPSHOT_DAYS = (dt.date(1996, 12, 31), dt.date(1998, 6, 30), dt.date(2001, 12, 31))
BATCH_CUT = dt.datetime(1997, 1, 1)       # deliveries up to here form batch 1
KNOWN_BY = dt.datetime(1998, 7, 1)        # bitemporal as-of: deliveries received by then
WINDOW_START, WINDOW_END = dt.date(1998, 1, 1), dt.date(1998, 2, 1)
AS_SEEN_ON = dt.date(1998, 7, 15)
BACKFILL_EVERY = "quarter"
EMPTY_DAY = dt.date(1990, 1, 1)            # before all events
ALL_TIME = dt.timedelta(days=36_500)       # an overlap that reads all deliveries again
LINE_CREATED_AT = dt.datetime(2000, 1, 1)  # lineage stamp used instead of the clock


def snapshot_stamp(day: dt.date) -> dt.datetime:
    """Run time of the daily job for ``day``: midnight after it."""
    return dt.datetime.combine(day + dt.timedelta(days=1), dt.time())


# ---------------------------------------------------------------- inputs


def _bronze(spark: SparkSession, sf: str, entity: Entity) -> DataFrame:
    events = testmap.events_for(spark, sf, entity.name)
    valid, _ = bronze.split_valid(bronze.typed_events(events, entity), entity)
    return valid


def _silver(spark: SparkSession, sf: str, entity: Entity) -> DataFrame:
    return silver.build_silver(_bronze(spark, sf, entity), entity, line_created_at=LINE_CREATED_AT)


def _events(spark: SparkSession, sf: str, entity: Entity) -> DataFrame:
    """Silver-shaped but undeduplicated events: as-of ranks them in one pass.

    Gold does not need the current-record flag, so when silver is not stored
    the as-of step reads the prepared events directly.
    """
    return silver.prepare_increment(_bronze(spark, sf, entity), entity, LINE_CREATED_AT)


def _all_events(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: _events(spark, sf, e) for name, e in ENTITIES.items()}


def _snapshot(ev: dict[str, DataFrame], day: dt.date, grain: str = "item") -> DataFrame:
    p = asof.as_of(ev["purchase"], PURCHASE, day)
    i = asof.as_of(ev["product_item"], PRODUCT_ITEM, day)
    x = asof.as_of(ev["purchase_extra_info"], EXTRA_INFO, day)
    return gold.purchase_snapshot(p, i, x, day, snapshot_stamp(day), grain=grain, item_events=ev["product_item"])


def _stamp_after(col: str = "snapshot_date"):
    """Run time of each day's job (midnight after the snapshot day), as a column."""
    return F.col(col).cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(1))


def _ledger_for(spark: SparkSession, sf: str, days, grain: str = "item") -> tuple[DataFrame, DataFrame]:
    """Snapshots of many days in one pass over validity intervals, and the paid
    purchases behind them (the cheaper input for the newest snapshot day)."""
    ev = _all_events(spark, sf)
    p = asof.as_of_many(ev["purchase"], PURCHASE, days)
    i = asof.as_of_many(ev["product_item"], PRODUCT_ITEM, days)
    x = asof.as_of_many(ev["purchase_extra_info"], EXTRA_INFO, days)
    ledger = gold.purchase_snapshot(p, i, x, snapshot_datetime=_stamp_after(), grain=grain, item_events=ev["product_item"])
    return ledger, gold.paid(p).select("snapshot_date")


def _ledger(spark: SparkSession, sf: str, grain: str = "item") -> DataFrame:
    """Ledger holding the daily snapshots of SNAPSHOT_DAYS."""
    return _ledger_for(spark, sf, SNAPSHOT_DAYS, grain)[0]


def _flagged_ledger(spark: SparkSession, sf: str, grain: str = "item") -> DataFrame:
    ledger, heads = _ledger_for(spark, sf, SNAPSHOT_DAYS, grain)
    return gold.mark_current_snapshot(ledger, days=heads)


def _stored(spark: SparkSession, make: Callable[[daily.Lake], DataFrame], event_partition: str = "month", **kept: bool) -> DataFrame:
    """What ``make`` reads from a lake in a fresh folder of the shared checkpoint
    folder; the result is stored beside it and the lake removed again."""
    lake = daily.Lake(scratch_path(spark, f"lake-{uuid.uuid4().hex}"), event_partition=event_partition, **kept)
    try:
        with storage.shuffles_released(spark):
            return storage.shelved(make(lake), scratch_path(spark, f"result-{uuid.uuid4().hex}"))
    finally:
        storage.remove(spark, lake.root)


def _on_stored_mart(spark: SparkSession, sf: str, report: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A report over the mart as published: one partition per snapshot day."""

    def make(lake: daily.Lake) -> DataFrame:
        mart = gold.gmv_by_subsidiary(_ledger(spark, sf))
        storage.replace_partitions(mart, lake.mart, ["snapshot_date"])
        return report(daily.read_mart(spark, lake))

    return _stored(spark, make)


def _no_clock(df: DataFrame) -> DataFrame:
    return df.drop("line_created_at")


# ---------------------------------------------------------------- reports


def q_top_producers(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_producers(testmap.report_purchase(spark, sf), testmap.report_product_item(spark, sf),
                                 REPORT_YEAR, TOP_N)


def q_top_products_per_producer(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_products_per_producer(testmap.report_purchase(spark, sf),
                                             testmap.report_product_item(spark, sf), TOP_K)


# ---------------------------------------------------------------- bronze


def _q_bronze(entity: Entity) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return _bronze(spark, sf, entity)

    return q


def q_arrival_gate(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.arrival_report({name: _bronze(spark, sf, e) for name, e in ENTITIES.items()})


def q_arrival_probe(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each table has events of a day: probes of one row."""
    days = (EMPTY_DAY, ASOF_CUTOFF)
    found = [(n, d, bronze.has_partition(_bronze(spark, sf, e), d)) for n, e in ENTITIES.items() for d in days]
    return spark.createDataFrame(found, "table_name string, transaction_date date, has_data boolean")


# ---------------------------------------------------------------- silver


def _q_silver(entity: Entity) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return _no_clock(_silver(spark, sf, entity))

    return q


def _two_batches(spark: SparkSession, sf: str, entity: Entity) -> tuple[DataFrame, DataFrame]:
    b = _bronze(spark, sf, entity)
    first = b.filter(F.col("ingestion_date") <= ntz(BATCH_CUT))
    return b, first


def q_silver_purchase_two_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Batch 1, then an incremental run from the high-water mark: equals one batch."""
    b, first = _two_batches(spark, sf, PURCHASE)
    s1 = silver.build_silver(first, PURCHASE, line_created_at=LINE_CREATED_AT)
    mark = first.agg(F.max("ingestion_date").alias("m")).first()["m"]  # the mark that s1 would give
    inc = silver.incremental_slice(b, mark)
    return _no_clock(silver.build_silver(inc, PURCHASE, history=s1, line_created_at=LINE_CREATED_AT))


def q_upsert_purchase(spark: SparkSession, sf: str) -> DataFrame:
    """MERGE of the second batch into the first batch's silver (touched keys only)."""
    b, first = _two_batches(spark, sf, PURCHASE)
    s1 = silver.build_silver(first, PURCHASE, line_created_at=LINE_CREATED_AT)
    second = b.filter(F.col("ingestion_date") > ntz(BATCH_CUT))
    return _no_clock(silver.upsert(s1, second, PURCHASE, line_created_at=LINE_CREATED_AT))


def q_silver_product_item_enriched(spark: SparkSession, sf: str) -> DataFrame:
    items = _silver(spark, sf, PRODUCT_ITEM)
    purchases = _silver(spark, sf, PURCHASE)
    return _no_clock(silver.enrich_from_current(items, purchases, key_source=_bronze(spark, sf, PRODUCT_ITEM)))


# ---------------------------------------------------------------- as-of


def _q_asof(entity: Entity) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return asof.as_of(_events(spark, sf, entity), entity, ASOF_CUTOFF)

    return q


def q_asof_item_known_by(spark: SparkSession, sf: str) -> DataFrame:
    return asof.as_of_known_by(_bronze(spark, sf, PRODUCT_ITEM), PRODUCT_ITEM, ASOF_CUTOFF, KNOWN_BY)


# ---------------------------------------------------------------- gold


def q_purchase_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshot(_all_events(spark, sf), ASOF_CUTOFF)


def q_snapshot_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return _flagged_ledger(spark, sf)


def q_snapshot_ledger_purchase_grain(spark: SparkSession, sf: str) -> DataFrame:
    return _flagged_ledger(spark, sf, grain="purchase")


def q_gmv_daily_by_subsidiary(spark: SparkSession, sf: str) -> DataFrame:
    ledger, heads = _ledger_for(spark, sf, SNAPSHOT_DAYS)
    return gold.gmv_daily(ledger, days=heads)


def q_gmv_current(spark: SparkSession, sf: str) -> DataFrame:
    return _on_stored_mart(spark, sf, reports.gmv_current)


def q_gmv_latest_window(spark: SparkSession, sf: str) -> DataFrame:
    return _on_stored_mart(spark, sf, lambda mart: reports.gmv_latest_window(mart, WINDOW_START, WINDOW_END))


def q_gmv_as_seen_on(spark: SparkSession, sf: str) -> DataFrame:
    return _on_stored_mart(spark, sf, lambda mart: reports.gmv_as_seen_on(mart, AS_SEEN_ON))


def backfill_days(spark: SparkSession, sf: str) -> list[dt.date]:
    """Quarter ends between the first and last event day of the purchase events."""
    span = _bronze(spark, sf, PURCHASE).agg(F.min("transaction_date").alias("lo"),
                                           F.max("transaction_date").alias("hi")).first()
    return asof.snapshot_grid(span["lo"], span["hi"], BACKFILL_EVERY)


def q_snapshot_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """GMV mart for every quarter end, from changes at the ends of validity intervals."""
    ev = _all_events(spark, sf)
    return backfill.gmv_of_days(ev["purchase"], ev["product_item"], ev["purchase_extra_info"], backfill_days(spark, sf))


# ---------------------------------------------------------------- quality


def q_quarantine_missing_items(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quarantine_missing_items(_ledger(spark, sf))


def q_dq_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dq_metrics(_ledger(spark, sf), run_datetime=_stamp_after())


# ---------------------------------------------------------------- storage runs


def _deliveries(spark: SparkSession, sf: str, entity: Entity) -> tuple[DataFrame, DataFrame]:
    """The entity's events split into two deliveries at BATCH_CUT (delivery stamps kept)."""
    ev = testmap.events_for(spark, sf, entity.name)
    cut = ntz(BATCH_CUT)
    return ev.filter(F.col("ingestion_date") <= cut), ev.filter(F.col("ingestion_date") > cut)


def _lake_gmv_daily(event_partition: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        """The full daily pipeline over Parquet storage, read back as the published mart.

        Two bronze deliveries per entity (append), a first and an incremental
        silver run (partition-scoped rewrite), gold for every snapshot day plus a
        rerun of one day (one-partition overwrite each), then the mart view.
        """

        def make(lake: daily.Lake) -> DataFrame:
            batches = {name: _deliveries(spark, sf, e) for name, e in ENTITIES.items()}
            for step in (0, 1):
                for name, e in ENTITIES.items():
                    daily.ingest(lake, batches[name][step], e, ingestion_at=F.col("ingestion_date"))
                    daily.run_silver(spark, lake, e, line_created_at=LINE_CREATED_AT)
            for day in (*SNAPSHOT_DAYS, SNAPSHOT_DAYS[1]):
                daily.run_gold(spark, lake, day, snapshot_stamp(day))
            return daily.mart_view(spark, lake)

        return _stored(spark, make, event_partition)

    return q


def q_lake_rerun_day(spark: SparkSession, sf: str) -> DataFrame:
    """A day run before most items have arrived, run again after they have, and a
    day without any purchase: metrics with the row counts of ledger and quarantine."""

    def make(lake: daily.Lake) -> DataFrame:
        late = {}
        for name, e in ENTITIES.items():
            first, late[name] = _deliveries(spark, sf, e)
            now = first if e is PRODUCT_ITEM else first.unionByName(late[name])
            daily.ingest(lake, now, e, ingestion_at=F.col("ingestion_date"))
            daily.run_silver(spark, lake, e, line_created_at=LINE_CREATED_AT)
        days = (EMPTY_DAY, ASOF_CUTOFF)
        for day in days:
            daily.run_gold(spark, lake, day, snapshot_stamp(day))
        daily.ingest(lake, late["product_item"], PRODUCT_ITEM, ingestion_at=F.col("ingestion_date"))
        daily.run_silver(spark, lake, PRODUCT_ITEM, line_created_at=LINE_CREATED_AT)
        for day in days:
            daily.run_gold(spark, lake, day, snapshot_stamp(day))
        ledger = daily.read_ledger(spark, lake).groupBy("snapshot_date").agg(F.count("*").alias("ledger_rows"))
        held = daily.quarantine_view(spark, lake).groupBy("snapshot_date").agg(F.count("*").alias("quarantine_rows"))
        out = daily.dq_view(spark, lake).join(ledger, "snapshot_date", "left").join(held, "snapshot_date", "left")
        return out.na.fill(0, ["ledger_rows", "quarantine_rows"])

    return _stored(spark, make)


def q_ledger_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger as a catalog table (DDL over the stored photos), read by SQL."""

    def make(lake: daily.Lake) -> DataFrame:
        # One write for all days; each photo replaces its own day only.
        storage.replace_partitions(_ledger(spark, sf), lake.ledger, ["snapshot_date"], SNAPSHOT_DAYS, ["transaction_date"])
        name = f"ledger_{uuid.uuid4().hex}"
        ddl.create_ledger_table(spark, name, lake.ledger)
        try:
            return storage.staged(spark.sql(
                f"SELECT snapshot_date, count(*) AS ledger_rows, count(DISTINCT purchase_id) AS purchases, "
                f"CAST(sum(item_quantity * purchase_value) AS DOUBLE) AS gmv_value FROM {name} GROUP BY snapshot_date"))
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    return _stored(spark, make)


def q_bronze_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Events per entity that keep the bronze rules, and that are rejected."""
    events = {n: bronze.typed_events(testmap.events_for(spark, sf, n), e) for n, e in ENTITIES.items()}
    return bronze.reject_report(events, ENTITIES)


def q_stream_silver_purchase(spark: SparkSession, sf: str) -> DataFrame:
    """Purchase silver maintained by an availableNow stream over two bronze deliveries."""

    def make(lake: daily.Lake) -> DataFrame:
        checkpoint = f"{lake.root}/_checkpoints/silver_purchase"
        for batch in _deliveries(spark, sf, PURCHASE):
            daily.ingest(lake, batch, PURCHASE, ingestion_at=F.col("ingestion_date"))
            q = silver_stream(spark, PURCHASE, lake, checkpoint, LINE_CREATED_AT)
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
        return _no_clock(daily.read_silver(spark, lake, PURCHASE))

    return _stored(spark, make)


def _run_silver(spark: SparkSession, lake: daily.Lake, entity: Entity, events: DataFrame, overlap: dt.timedelta | None = daily.OVERLAP) -> None:
    daily.ingest(lake, events, entity, ingestion_at=F.col("ingestion_date"))
    daily.run_silver(spark, lake, entity, line_created_at=LINE_CREATED_AT, overlap=overlap)


def q_silver_redelivered(spark: SparkSession, sf: str) -> DataFrame:
    """Item silver after a run over all items and one over redeliveries of some of
    them under their first stamps with another value: deduplication decides."""

    def make(lake: daily.Lake) -> DataFrame:
        items = testmap.events_for(spark, sf, PRODUCT_ITEM.name)
        _run_silver(spark, lake, PRODUCT_ITEM, items)
        _run_silver(spark, lake, PRODUCT_ITEM, testmap.revalued_items(items), overlap=ALL_TIME)
        return _no_clock(daily.read_silver(spark, lake, PRODUCT_ITEM))

    return _stored(spark, make)


def q_silver_touched_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Purchase partitions that late items belong to, found by the stored key index,
    with the number of such purchases each holds."""

    def make(lake: daily.Lake) -> DataFrame:
        _run_silver(spark, lake, PURCHASE, _deliveries(spark, sf, PURCHASE)[0])
        keys = _deliveries(spark, sf, PRODUCT_ITEM)[1].select("purchase_id").distinct()
        near = daily.silver_parts(spark, lake, PURCHASE, daily.partitions_with(spark, lake, PURCHASE, keys))
        met = near.select(lake.event_part_col, "purchase_id").join(keys, "purchase_id", "left_semi")
        return met.groupBy(lake.event_part_col).agg(F.count_distinct("purchase_id").alias("purchases"))

    return _stored(spark, make)


def q_asof_purchase_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Purchase state of a day from the validity intervals that two silver runs have kept."""

    def make(lake: daily.Lake) -> DataFrame:
        for batch in _deliveries(spark, sf, PURCHASE):
            _run_silver(spark, lake, PURCHASE, batch)
        return states.as_of_states(daily.read_states(spark, lake, PURCHASE), PURCHASE, ASOF_CUTOFF)

    return _stored(spark, make, states=True)


def q_gmv_restated(spark: SparkSession, sf: str) -> DataFrame:
    """The mart of the snapshot days, stored after the first deliveries and restated
    after the second ones by what these change."""

    def make(lake: daily.Lake) -> DataFrame:
        batches = {n: _deliveries(spark, sf, e) for n, e in ENTITIES.items()}
        for step, days in ((0, SNAPSHOT_DAYS), (1, ())):
            for n, e in ENTITIES.items():
                _run_silver(spark, lake, e, batches[n][step])
            daily.restate(spark, lake, days)
        return daily.restated_view(spark, lake)

    return _stored(spark, make, changes=True)


def q_gmv_report_views(spark: SparkSession, sf: str) -> DataFrame:
    """The current report in SQL, over temp views of the stored mart."""

    def make(lake: daily.Lake) -> DataFrame:
        storage.replace_partitions(gold.gmv_by_subsidiary(_ledger(spark, sf)), lake.mart, ["snapshot_date"])
        views = ddl.publish_reports(spark, lake.mart, f"gmv_{uuid.uuid4().hex}")
        try:
            return storage.staged(spark.sql(
                f"SELECT subsidiary, count(*) AS release_days, sum(gmv_value) AS gmv_value, sum(transaction_count) AS transaction_count "
                f"FROM {views['current']} GROUP BY subsidiary"))
        finally:
            ddl.drop_reports(spark, views)

    return _stored(spark, make)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_producers": q_top_producers,
    "top_products_per_producer": q_top_products_per_producer,
    "bronze_purchase": _q_bronze(PURCHASE),
    "bronze_product_item": _q_bronze(PRODUCT_ITEM),
    "bronze_extra_info": _q_bronze(EXTRA_INFO),
    "arrival_gate": q_arrival_gate,
    "arrival_probe": q_arrival_probe,
    "silver_purchase": _q_silver(PURCHASE),
    "silver_product_item": _q_silver(PRODUCT_ITEM),
    "silver_extra_info": _q_silver(EXTRA_INFO),
    "silver_purchase_two_batch": q_silver_purchase_two_batch,
    "upsert_purchase": q_upsert_purchase,
    "silver_product_item_enriched": q_silver_product_item_enriched,
    "asof_purchase": _q_asof(PURCHASE),
    "asof_item": _q_asof(PRODUCT_ITEM),
    "asof_extra": _q_asof(EXTRA_INFO),
    "asof_item_known_by": q_asof_item_known_by,
    "purchase_snapshot": q_purchase_snapshot,
    "snapshot_ledger": q_snapshot_ledger,
    "snapshot_ledger_purchase_grain": q_snapshot_ledger_purchase_grain,
    "gmv_daily_by_subsidiary": q_gmv_daily_by_subsidiary,
    "gmv_current": q_gmv_current,
    "gmv_latest_window": q_gmv_latest_window,
    "gmv_as_seen_on": q_gmv_as_seen_on,
    "snapshot_backfill": q_snapshot_backfill,
    "quarantine_missing_items": q_quarantine_missing_items,
    "dq_metrics": q_dq_metrics,
    "lake_gmv_daily": _lake_gmv_daily("month"),
    "lake_rerun_day": q_lake_rerun_day,
    "ledger_catalog": q_ledger_catalog,
    "bronze_rejects": q_bronze_rejects,
    "stream_silver_purchase": q_stream_silver_purchase,
    "silver_redelivered": q_silver_redelivered,
    "silver_touched_partitions": q_silver_touched_partitions,
    "asof_purchase_stored": q_asof_purchase_stored,
    "gmv_restated": q_gmv_restated,
    "gmv_report_views": q_gmv_report_views,
}
