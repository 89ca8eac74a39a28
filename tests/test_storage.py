"""Daily runs over real Parquet storage: bronze append, partition-scoped silver,
immutable ledger photos, idempotent reruns, catalog DDL, arrival gate."""

import datetime as dt
import os

from pyspark.sql import functions as F

import fixtures as FX
from snapledger.model import ENTITIES, PRODUCT_ITEM, PURCHASE
from snapledger.operators import silver
from snapledger.plans import daily, ddl
from snapledger.sources import storage

STAMP = dt.datetime(2026, 2, 27, 12, 0)


def _ingest_reference(spark, lake, deliveries=FX.DELIVERIES):
    b = FX.reference_bronze(spark)
    for name, e in ENTITIES.items():
        for d in deliveries:
            part = b[name].filter(F.col("ingestion_date") == F.lit(FX.ts(d)))
            daily.ingest(lake, part.drop("ingestion_date"), e, FX.ts(d))


def _rows(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()))


def test_read_or_empty_and_missing_only(spark, lake_root):
    assert storage.read_table(spark, lake_root + "/nothing", PURCHASE.bronze_schema) is None
    empty = storage.read_or_empty(spark, lake_root + "/nothing", PURCHASE.bronze_schema)
    assert empty.count() == 0 and empty.schema == PURCHASE.bronze_schema


def test_daily_pipeline_and_idempotent_rerun(spark, lake_root):
    lake = daily.Lake(lake_root)
    _ingest_reference(spark, lake)
    assert daily.arrived(spark, lake, PURCHASE, "2023-02-26")
    assert not daily.arrived(spark, lake, PURCHASE, "2023-02-27")
    daily.run_day(spark, lake, "2023-03-31", STAMP, line_created_at=STAMP)
    daily.run_gold(spark, lake, "2023-07-15", STAMP)
    mart = daily.mart_view(spark, lake)
    cur = mart.filter("is_current_snapshot")
    assert FX.mart_rows(cur) == FX.GMV_BY_CUTOFF["2023-07-15"]
    old = mart.filter(F.col("snapshot_date") == F.lit(dt.date(2023, 3, 31)))
    assert FX.mart_rows(old) == FX.GMV_BY_CUTOFF["2023-03-31"]
    before = _rows(daily.read_ledger(spark, lake), daily.read_ledger(spark, lake).columns)
    daily.run_gold(spark, lake, "2023-03-31", STAMP)  # rerun of a past day
    after = _rows(daily.read_ledger(spark, lake), daily.read_ledger(spark, lake).columns)
    assert before == after
    dq = daily.dq_view(spark, lake)
    assert dq.count() == 2  # one row per day, reruns replace it
    assert daily.quarantine_view(spark, lake).count() == 0


def test_silver_increment_rewrites_only_touched_days(spark, lake_root):
    lake = daily.Lake(lake_root)
    _ingest_reference(spark, lake, FX.DELIVERIES[:1])
    daily.run_silver(spark, lake, PURCHASE, line_created_at=STAMP)
    path = lake.silver(PURCHASE)
    untouched = os.path.join(path, "transaction_date=2023-01-26")
    before = sorted(os.listdir(untouched))
    # A later delivery of purchase 69 (corrected order date) only.
    b = FX.reference_bronze(spark)["purchase"]
    fix = b.filter((F.col("ingestion_date") == F.lit(FX.ts(FX.DELIVERIES[1]))) & (F.col("purchase_id") == 69))
    daily.ingest(lake, fix.drop("ingestion_date"), PURCHASE, FX.ts(FX.DELIVERIES[1]))
    daily.run_silver(spark, lake, PURCHASE, line_created_at=STAMP)
    assert sorted(os.listdir(untouched)) == before  # partition of purchase 56 was not rewritten
    s = daily.read_silver(spark, lake, PURCHASE)
    assert s.count() == 5
    r = s.filter("purchase_id = 69").collect()
    assert len(r) == 1 and r[0]["order_date"] == dt.date(2023, 1, 26)
    # Rerunning with nothing new leaves the table equal.
    cols = [c for c in s.columns]
    snap1 = _rows(s, cols)
    daily.run_silver(spark, lake, PURCHASE, line_created_at=STAMP)
    assert _rows(daily.read_silver(spark, lake, PURCHASE), cols) == snap1


def test_bronze_rejects_bad_rows(spark, lake_root):
    lake = daily.Lake(lake_root)
    raw = FX.raw(spark, [("2023-01-20 22:02:00", "2023-01-21", "55", "1", "1", "1.00"),
                         ("not a time", "2023-01-20", "55", "1", "1", "1.00"),
                         ("2023-01-20 22:02:00", "2023-01-20", "55", "1", "1", "1.00")], FX.ITEM_COLS)
    daily.ingest(lake, raw, PRODUCT_ITEM, STAMP)
    assert spark.read.parquet(lake.bronze(PRODUCT_ITEM)).count() == 1
    assert spark.read.parquet(lake.rejects(PRODUCT_ITEM)).count() == 2


def test_ledger_ddl_table(spark, lake_root):
    lake = daily.Lake(lake_root)
    _ingest_reference(spark, lake)
    daily.run_day(spark, lake, "2023-07-15", STAMP, line_created_at=STAMP)
    ddl.create_ledger_table(spark, "gold_ledger_test", lake.ledger)
    n = spark.sql("SELECT count(*) FROM gold_ledger_test WHERE snapshot_date = DATE'2023-07-15'").first()[0]
    assert n == 2
    spark.sql("DROP TABLE gold_ledger_test")


def test_staged_cuts_lineage(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    s = storage.staged(df)
    assert s.count() == 10
    assert "LogicalRDD" in s._jdf.queryExecution().logical().toString()


def test_merge_increment_splits_changed_and_unchanged(spark):
    b = FX.reference_bronze(spark)["purchase"]
    first = b.filter(F.col("ingestion_date") == F.lit(FX.ts(FX.DELIVERIES[0])))
    s1 = silver.build_silver(first, PURCHASE, line_created_at=STAMP)
    inc = b.filter((F.col("ingestion_date") == F.lit(FX.ts(FX.DELIVERIES[1]))) & (F.col("purchase_id") == 69))
    changed, unchanged = silver.merge_increment(s1, inc, PURCHASE, STAMP)
    assert {r[0] for r in changed.select("purchase_id").collect()} == {69}
    assert unchanged.filter("purchase_id = 69").count() == 0


def test_month_layout_gives_same_mart(spark, lake_root):
    lake = daily.Lake(lake_root, event_partition="month")
    _ingest_reference(spark, lake)
    daily.run_day(spark, lake, "2023-03-31", STAMP, line_created_at=STAMP)
    daily.run_gold(spark, lake, "2023-07-15", STAMP)
    mart = daily.mart_view(spark, lake)
    assert FX.mart_rows(mart.filter("is_current_snapshot")) == FX.GMV_BY_CUTOFF["2023-07-15"]
    assert FX.mart_rows(mart.filter(F.col("snapshot_date") == F.lit(dt.date(2023, 3, 31)))) == \
        FX.GMV_BY_CUTOFF["2023-03-31"]
    assert sorted(os.listdir(lake.silver(PURCHASE)))[0].startswith("transaction_month=")
