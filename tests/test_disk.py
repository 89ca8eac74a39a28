"""What keeps the disk of storing runs small: one shuffle per silver pass, passes over slices, files that go after use."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

import fixtures as FX
from snapledger.model import ENTITIES, PRODUCT_ITEM
from snapledger.operators import silver
from snapledger.plans import daily
from snapledger.sources import storage
from test_plans import plan

STAMP = dt.datetime(2026, 2, 27, 12, 0)


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _silver_and_ready(spark):
    """Items in silver and prepared redeliveries: later, equal and older ones, new events and new keys."""
    rng, start = random.Random(3), dt.datetime(2024, 1, 1)

    def events(n, purchases):
        out = []
        for _ in range(n):
            t = start + dt.timedelta(hours=rng.randint(0, 30))
            p = 1 if rng.random() < 0.4 else rng.choice(purchases)  # purchase 1 is hot
            out.append((t, t.date(), p, 7, rng.randint(1, 3), None, t + dt.timedelta(days=rng.randint(1, 3))))
        return silver.prepare_increment(spark.createDataFrame(out, PRODUCT_ITEM.bronze_schema), PRODUCT_ITEM, STAMP)

    return silver.mark_current(silver.dedup_events(events(150, range(2, 30)), PRODUCT_ITEM), PRODUCT_ITEM), events(60, range(20, 45))


def _given(stored, ready):
    none = F.lit(None).cast("boolean")
    return stored.withColumnRenamed(silver.FLAG, "_was").withColumn("_stored", F.lit(True)).unionByName(
        ready.withColumns({"_stored": F.lit(False), "_was": none}))


def test_fold_gives_what_dedup_and_flag_give(spark):
    stored, ready = (spark.createDataFrame(d.collect(), d.schema) for d in _silver_and_ready(spark))
    whole = silver.mark_current(silver.dedup_events(stored.drop(silver.FLAG).unionByName(ready), PRODUCT_ITEM), PRODUCT_ITEM)
    touched = {r[0] for r in ready.select("purchase_id").distinct().collect()}
    was = {r[0] for r in stored.select("purchase_id").distinct().collect()}
    rows = _given(stored, ready)
    assert silver.heavy_keys(rows, PRODUCT_ITEM) is None
    spark.conf.set("snapledger.skew.keyRows", "20")
    try:
        heavy = silver.heavy_keys(rows, PRODUCT_ITEM)
        assert [r["purchase_id"] for r in heavy.collect()] == [1]
    finally:
        spark.conf.unset("snapledger.skew.keyRows")
    for keys in (None, heavy):
        out = silver.fold(rows, PRODUCT_ITEM, keys).cache()
        assert rows_of(out.where("_kept").select(*whole.columns)) == rows_of(whole)
        old = out.where("_stored AND _touched").withColumn(silver.FLAG, F.col("_was")).select(*stored.columns)
        assert rows_of(old) == rows_of(stored.where(F.col("purchase_id").isin(sorted(touched))))
        assert sorted(r["purchase_id"] for r in out.where("_fresh").collect()) == sorted(touched - was)


def test_fold_shuffles_and_sorts_the_rows_once(spark):
    p = plan(silver.fold(_given(*(spark.createDataFrame(d.collect(), d.schema) for d in _silver_and_ready(spark))), PRODUCT_ITEM))
    assert p.count("Exchange hashpartitioning") == 1 and p.count("Sort [") == 1, p


def _run(spark, root):
    lake = daily.Lake(root, event_partition="month", changes=True)
    b = FX.reference_bronze(spark)
    for n, d in enumerate(FX.DELIVERIES[:2]):
        for name, e in ENTITIES.items():
            daily.ingest(lake, b[name].filter(F.col("ingestion_date") == F.lit(FX.ts(d))).drop("ingestion_date"), e, FX.ts(d))
            daily.run_silver(spark, lake, e, line_created_at=STAMP)
        daily.restate(spark, lake, ["2023-07-15"] if n == 0 else ())
    daily.run_gold(spark, lake, "2023-07-15", STAMP)
    tables = [daily.read_silver(spark, lake, e) for e in ENTITIES.values()]
    return lake, [rows_of(t) for t in [*tables, daily.read_ledger(spark, lake), daily.mart_view(spark, lake), daily.restated_view(spark, lake)]]


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_slices_give_the_same_tables_and_leave_nothing(spark, tmp_path, monkeypatch):
    at_once = _run(spark, str(tmp_path / "one"))[1]
    passes, fold = [], silver.fold
    monkeypatch.setattr(silver, "fold", lambda *args: passes.append(1) or fold(*args))
    monkeypatch.setattr(daily, "SLICE_ROWS", 1)
    before = _shuffle_files(spark)
    lake, sliced = _run(spark, str(tmp_path / "many"))
    assert len(passes) > 2 * len(ENTITIES) and sliced == at_once
    left = _shuffle_files(spark) - before
    # Only reads outside the steps may leave shuffle files.
    assert len(left) <= 20, left
    assert not os.listdir(f"{lake.root}/staging")
    assert spark.conf.get(storage.SHUFFLE_CLEANUP, None) in (None, "false")
