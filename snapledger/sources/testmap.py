"""Change-event views derived from the TPC-H-like star schema.

The provided tables have no change history, so each entity's bronze events are
derived from them by fixed rules: orders become purchase "created" events, a
"released" event for every order not in status 'P', and redeliveries; line
items become item events plus a corrected redelivery; order regions become
extra-info events plus a later "moved" event. All derivations are narrow
projections and filters (no shuffle) except the extra-info dimension lookups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.functions.columns import days_after, hours_after
from snapledger.model import MONEY

# Fixed derivation parameters of the event views.
PRODUCER_MODULUS = 300          # producer_id = o_custkey % 300
RELEASE_DELAY_MODULUS = 5       # released o_orderkey % 5 + 1 days after the order
PURCHASE_REDELIVERY_MODULUS = 7  # orders with o_orderkey % 7 = 0 are delivered twice
ITEM_CORRECTION_MODULUS = 11    # lines with l_orderkey % 11 = 0 get a corrected redelivery
EXTRA_SKIP_MODULUS = 10         # orders with o_orderkey % 10 = 0 never get extra info
EXTRA_DELAY_MODULUS = 30        # extra info arrives o_orderkey % 30 days after the order
EXTRA_MOVE_MODULUS = 13         # extra info of o_orderkey % 13 = 0 moves 60 days later
EXTRA_MOVE_DAYS = 60
MOVED_SUBSIDIARY = "MOVED"
REVALUED_MODULUS = 5            # items of purchase_id % 5 = 0 come again under the same stamp
ITEM_PARTITIONS = 8             # prod_item_partition = key % 8 in the report inputs



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


def _events(df: DataFrame, *events: Column) -> DataFrame:
    """One row per event that is not null, from one pass over ``df``."""
    each = F.explode(F.filter(F.array(*events), lambda e: e.isNotNull()))
    return df.select(each.alias("e")).select("e.*")


def purchase_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    released_at = days_after("o_orderdate", F.col("o_orderkey") % RELEASE_DELAY_MODULUS + 1)

    def event(ts, release, ingestion):
        return F.struct(
            ts.alias("transaction_datetime"),
            F.to_date(ts).alias("transaction_date"),
            F.col("o_orderkey").alias("purchase_id"),
            F.col("o_custkey").alias("buyer_id"),
            F.col("o_orderkey").alias("prod_item_id"),
            F.to_date("o_orderdate").alias("order_date"),
            release.alias("release_date"),
            (F.col("o_custkey") % PRODUCER_MODULUS).alias("producer_id"),
            ingestion.alias("ingestion_date"),
        )

    no_release = F.lit(None).cast("date")
    return _events(
        _orders(spark, sf_dir),
        event(F.col("o_orderdate"), no_release, days_after("o_orderdate", 1)),
        F.when(F.col("o_orderstatus") != "P", event(released_at, F.to_date(released_at), days_after(released_at, 1))),
        F.when(F.col("o_orderkey") % PURCHASE_REDELIVERY_MODULUS == 0,
               event(F.col("o_orderdate"), no_release, days_after("o_orderdate", 2))),
    )


def item_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    value = F.col("l_extendedprice").cast(MONEY)

    def event(v, ingestion):
        return F.struct(
            F.col("l_shipdate").alias("transaction_datetime"),
            F.to_date("l_shipdate").alias("transaction_date"),
            F.col("l_orderkey").alias("purchase_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("item_quantity"),
            v.cast(MONEY).alias("purchase_value"),
            ingestion.alias("ingestion_date"),
        )

    return _events(
        li,
        event(value, hours_after("l_shipdate", F.col("l_linenumber"))),
        F.when(F.col("l_orderkey") % ITEM_CORRECTION_MODULUS == 0,
               event(value + F.lit(1).cast(MONEY), hours_after("l_shipdate", F.col("l_linenumber") + 24))),
    )


def extra_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir).filter(F.col("o_orderkey") % EXTRA_SKIP_MODULUS != 0)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # The star schema fixes nation and region at 25 and 5 rows, whatever the scale.
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    cust_region = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey).select("c_custkey", "r_name")
    base = o.join(cust_region, o.o_custkey == cust_region.c_custkey)

    def event(ts, subsidiary):
        return F.struct(
            ts.alias("transaction_datetime"),
            F.to_date(ts).alias("transaction_date"),
            F.col("o_orderkey").alias("purchase_id"),
            subsidiary.alias("subsidiary"),
            days_after(ts, 1).alias("ingestion_date"),
        )

    return _events(
        base,
        event(days_after("o_orderdate", F.col("o_orderkey") % EXTRA_DELAY_MODULUS), F.col("r_name")),
        F.when(F.col("o_orderkey") % EXTRA_MOVE_MODULUS == 0,
               event(days_after("o_orderdate", F.col("o_orderkey") % EXTRA_DELAY_MODULUS + EXTRA_MOVE_DAYS), F.lit(MOVED_SUBSIDIARY))),
    )


def report_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``purchase`` input of the ad-hoc revenue reports."""
    o = _orders(spark, sf_dir)
    released_at = days_after("o_orderdate", F.col("o_orderkey") % RELEASE_DELAY_MODULUS + 1)
    return o.select(
        F.col("o_orderkey").alias("purchase_id"),
        (F.col("o_custkey") % PRODUCER_MODULUS).alias("producer_id"),
        F.col("o_orderkey").alias("prod_item_id"),
        (F.col("o_orderkey") % ITEM_PARTITIONS).alias("prod_item_partition"),
        F.to_date("o_orderdate").alias("order_date"),
        F.when(F.col("o_orderstatus") != "P", F.to_date(released_at)).alias("release_date"),
    )


def report_product_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``product_item`` input of the ad-hoc revenue reports."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("prod_item_id"),
        (F.col("l_orderkey") % ITEM_PARTITIONS).alias("prod_item_partition"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast(MONEY).alias("purchase_value"),
        F.col("l_quantity").cast("int").alias("item_quantity"),
    )


EVENT_VIEWS = {
    "purchase": purchase_events,
    "product_item": item_events,
    "purchase_extra_info": extra_events,
}


def events_for(spark: SparkSession, sf_dir: str, entity_name: str) -> DataFrame:
    """Bronze-shaped events of one entity."""
    return EVENT_VIEWS[entity_name](spark, sf_dir)


def revalued_items(items: DataFrame) -> DataFrame:
    """Redeliveries of item events under their first stamps, worth 2 more (or less)."""
    up = F.when(F.col("purchase_id") % 2 == 0, 2).otherwise(-2).cast(MONEY)
    again = items.where(F.col("purchase_id") % REVALUED_MODULUS == 0)
    return again.withColumn("purchase_value", (F.col("purchase_value") + up).cast(MONEY))
