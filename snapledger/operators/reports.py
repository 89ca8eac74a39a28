"""Revenue reports: ad-hoc top-N queries and reads of the GMV mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapledger.functions.columns import as_date, gmv_amount, money_to_double, year_bounds

ITEM_JOIN_KEY = ["prod_item_id", "prod_item_partition"]


def _amounts(product_item: DataFrame, keys: list[str]) -> DataFrame:
    """The value of all items of a key, summed in the map tasks first."""
    return product_item.groupBy(*keys).agg(F.sum(gmv_amount()).alias("_amount"))


def top_producers(purchase: DataFrame, product_item: DataFrame, year: int, n: int = 50) -> DataFrame:
    """Top ``n`` producers by revenue of paid purchases ordered in ``year``.

    The year is a half-open date range so it reaches the Parquet scan; the
    sort + limit plans as TakeOrderedAndProject (only ``n`` rows per task
    travel). Items are summed per join key before the join, so a key with very
    many items shrinks in the map tasks, and the join reuses the sum's
    partitioning. Ties on revenue are broken by producer_id.
    """
    start, end = year_bounds(year)
    p = purchase.filter(
        (F.col("order_date") >= F.lit(start)) & (F.col("order_date") < F.lit(end))
        & F.col("release_date").isNotNull()
    ).select("producer_id", *ITEM_JOIN_KEY)
    rev = p.join(_amounts(product_item, ITEM_JOIN_KEY), ITEM_JOIN_KEY).groupBy("producer_id").agg(F.sum("_amount").alias("_rev"))
    return (
        rev.orderBy(F.col("_rev").desc_nulls_last(), F.col("producer_id").asc_nulls_last())
        .limit(n)
        .select("producer_id", money_to_double(F.col("_rev")).alias("total_revenue"))
    )


def top_products_per_producer(purchase: DataFrame, product_item: DataFrame, k: int = 2) -> DataFrame:
    """Best ``k`` products per producer by revenue of paid purchases.

    ``row_number() <= k`` plans as a WindowGroupLimit with a partial step
    before the shuffle, so a producer with very many products sends at most
    ``k`` rows per map task. Items are summed per join key and product before the
    join. Ties are broken by product_id.
    """
    p = purchase.filter(F.col("release_date").isNotNull()).select("producer_id", *ITEM_JOIN_KEY)
    i = _amounts(product_item, [*ITEM_JOIN_KEY, "product_id"])
    rev = p.join(i, ITEM_JOIN_KEY).groupBy("producer_id", "product_id").agg(F.sum("_amount").alias("_rev"))
    w = Window.partitionBy("producer_id").orderBy(F.col("_rev").desc_nulls_last(), F.col("product_id").asc_nulls_last())
    top = rev.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    return top.select(
        "producer_id", "product_id", money_to_double(F.col("_rev")).alias("product_revenue")
    ).orderBy("producer_id", F.col("product_revenue").desc(), "product_id")


REPORT_COLS = ["release_date", "subsidiary", "gmv_value", "transaction_count"]


def gmv_current(mart: DataFrame) -> DataFrame:
    """Daily GMV by subsidiary in the current (newest) snapshot: over the stored
    mart the newest day is a partition value, and only its partition is read."""
    newest = mart.select(F.max("snapshot_date")).scalar()
    return mart.filter(F.col("snapshot_date") == newest).select(*REPORT_COLS).orderBy("release_date", "subsidiary")


def gmv_latest_window(mart: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Newest snapshot, release days in [start, end)."""
    newest = mart.select(F.max("snapshot_date")).scalar()
    return (
        mart.filter(
            (F.col("snapshot_date") == newest)
            & (F.col("release_date") >= F.lit(as_date(start)))
            & (F.col("release_date") < F.lit(as_date(end)))
        )
        .select(*REPORT_COLS)
        .orderBy("release_date", "subsidiary")
    )


def gmv_as_seen_on(mart: DataFrame, ref_date: str | dt.date) -> DataFrame:
    """Time travel: the mart as published in the newest snapshot on or before ``ref_date``."""
    ref = F.lit(as_date(ref_date))
    seen = mart.filter(F.col("snapshot_date") <= ref).select(F.max("snapshot_date")).scalar()
    return (
        mart.filter((F.col("snapshot_date") <= ref) & (F.col("snapshot_date") == seen))
        .select("snapshot_date", *REPORT_COLS)
        .orderBy("release_date", "subsidiary")
    )
