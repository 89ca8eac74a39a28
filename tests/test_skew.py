"""A purchase holding a third of all item events: results stay exact (checked
against a brute-force pandas computation) and the hot key is salted in the join."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from snapledger.functions.skew import salted_join
from snapledger.model import EXTRA_INFO, PRODUCT_ITEM, PURCHASE
from snapledger.operators import asof, bronze, gold, silver

DAY = dt.date(2024, 1, 31)
N_PURCHASES = 3_000
HOT = 1


def _events(spark):
    base = dt.datetime(2024, 1, 1)
    purchases = spark.range(1, N_PURCHASES + 1).select(
        F.lit(base).cast("timestamp_ntz").alias("transaction_datetime"),
        F.lit(base.date()).alias("transaction_date"),
        F.col("id").alias("purchase_id"), F.col("id").alias("buyer_id"), F.col("id").alias("prod_item_id"),
        F.lit(base.date()).alias("order_date"),
        F.when(F.col("id") % 3 != 0, F.lit(base.date())).alias("release_date"),
        (F.col("id") % 7).alias("producer_id"))
    # Two items per purchase, plus as many items again on the hot purchase, each delivered twice.
    normal = spark.range(0, 2 * N_PURCHASES).select((F.col("id") % N_PURCHASES + 1).alias("purchase_id"),
                                                     F.col("id").alias("product_id"))
    hot = spark.range(0, 3 * N_PURCHASES).select(F.lit(HOT).cast("long").alias("purchase_id"),
                                                  (F.col("id") + 10**6).alias("product_id"))
    items = normal.unionByName(hot).select(
        F.lit(base + dt.timedelta(hours=1)).cast("timestamp_ntz").alias("transaction_datetime"),
        F.lit(base.date()).alias("transaction_date"), "purchase_id", "product_id",
        (F.col("product_id") % 5 + 1).cast("int").alias("item_quantity"),
        (F.col("product_id") % 100 + 1).cast("decimal(18,2)").alias("purchase_value"))
    extra = spark.range(1, N_PURCHASES + 1, 2).select(
        F.lit(base).cast("timestamp_ntz").alias("transaction_datetime"), F.lit(base.date()).alias("transaction_date"),
        F.col("id").alias("purchase_id"), F.lit("nacional").alias("subsidiary"))

    def stamped(df, entity, hours):
        return bronze.stamp_ingestion(bronze.typed_events(df, entity), dt.datetime(2024, 2, 1, hours))

    return (stamped(purchases, PURCHASE, 1),
            stamped(items, PRODUCT_ITEM, 1).unionByName(stamped(items, PRODUCT_ITEM, 2)),
            stamped(extra, EXTRA_INFO, 1))


@pytest.fixture
def skew_conf(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            # Force shuffle joins: at this size AQE would otherwise broadcast.
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "snapledger.skew.keyRows": "500"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_purchase_exact_and_split(spark, skew_conf):
    p, i, x = _events(spark)
    ready = {e.name: silver.prepare_increment(df, e, dt.datetime(2024, 2, 2))
             for e, df in ((PURCHASE, p), (PRODUCT_ITEM, i), (EXTRA_INFO, x))}
    snap = gold.purchase_snapshot(asof.as_of(ready["purchase"], PURCHASE, DAY),
                                  asof.as_of(ready["product_item"], PRODUCT_ITEM, DAY),
                                  asof.as_of(ready["purchase_extra_info"], EXTRA_INFO, DAY),
                                  DAY, dt.datetime(2024, 2, 2))
    mart = gold.gmv_by_subsidiary(snap)
    got = {(r["subsidiary"], round(r["gmv_value"] or 0.0, 2), r["transaction_count"]) for r in mart.collect()}
    rows = snap.count()

    # Brute force in pandas on the same events.
    pp = p.toPandas()
    pp = pp[pp.release_date.notna()]
    ii = i.toPandas().drop_duplicates(["purchase_id", "product_id"])
    xx = x.toPandas()
    j = pp.merge(ii, on="purchase_id", how="left").merge(xx[["purchase_id", "subsidiary"]], on="purchase_id",
                                                         how="left")
    j["subsidiary"] = j["subsidiary"].fillna("UNKNOWN")
    j["g"] = j.item_quantity.astype(float) * j.purchase_value.astype(float)
    want = {(s, round(g.g.sum(), 2), g.purchase_id.nunique()) for s, g in j.groupby("subsidiary")}
    assert rows == len(j)
    assert got == want



def test_hot_key_rows_are_spread_over_tasks(spark, skew_conf):
    _, items, _ = _events(spark)
    small = items.select("purchase_id").distinct().withColumn("tag", F.col("purchase_id") * 2)
    # Without the skew split of the runtime, only the parts can spread the hot key.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(items, small, ["purchase_id"])
        per_task = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    total, hot = items.count(), items.where(F.col("purchase_id") == HOT).count()
    assert sum(per_task) == total
    assert max(per_task) < hot / 2  # one task would hold all of the hot key's rows


def test_salted_join_builds_without_a_job(spark, skew_conf):
    _, items, _ = _events(spark)
    tracker, group = spark.sparkContext.statusTracker(), "salted-join-build"
    spark.sparkContext.setJobGroup(group, "plan only")
    salted_join(items, items.select("purchase_id").distinct(), ["purchase_id"], "left")
    assert not tracker.getJobIdsForGroup(group)
