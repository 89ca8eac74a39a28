"""Typed-in events of the original case study and the extra cases, as raw strings.

They go through the bronze cast step like any delivery. Values below are fixed
values of the case study and must stay exactly as written.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.model import EXTRA_INFO, PRODUCT_ITEM, PURCHASE
from snapledger.operators import bronze

# --- fixed values: reference input events --------------------------------------
PURCHASE_ROWS = [
    # transaction_datetime, transaction_date, purchase_id, buyer_id, prod_item_id, order_date, release_date, producer_id
    ("2023-01-20 22:00:00", "2023-01-20", "55", "15947", "5", "2023-01-20", "2023-01-20", "852852"),
    ("2023-01-26 00:01:00", "2023-01-26", "56", "369798", "746520", "2023-01-25", None, "963963"),
    ("2023-02-05 10:00:00", "2023-02-05", "55", "160001", "5", "2023-01-20", "2023-01-20", "852852"),
    ("2023-02-26 03:00:00", "2023-02-26", "69", "160001", "18", "2023-01-26", "2023-02-28", "96967"),
    ("2023-07-15 09:00:00", "2023-07-15", "55", "160001", "5", "2023-01-20", "2023-03-01", "852852"),
]
ITEM_ROWS = [
    # transaction_datetime, transaction_date, purchase_id, product_id, item_quantity, purchase_value
    ("2023-01-20 22:02:00", "2023-01-20", "55", "696969", "10", "50.00"),
    ("2023-01-25 23:59:59", "2023-01-25", "56", "808080", "120", "2400.00"),
    ("2023-02-26 03:00:00", "2023-02-26", "69", "373737", "2", "2000.00"),
    ("2023-07-12 09:00:00", "2023-07-12", "55", "696969", "10", "55.00"),
]
EXTRA_ROWS = [
    # transaction_datetime, transaction_date, purchase_id, subsidiary
    ("2023-01-23 00:05:00", "2023-01-23", "55", "nacional"),
    ("2023-01-25 23:59:59", "2023-01-25", "56", "internacional"),
    ("2023-02-28 01:10:00", "2023-02-28", "69", "nacional"),
    ("2023-03-12 07:00:00", "2023-03-12", "69", "internacional"),
]
# Recorded redelivery: the first delivery of purchase 69 carried order_date 2023-02-26.
FIRST_DELIVERY_ORDER_DATE_69 = "2023-02-26"
DELIVERIES = ["2026-02-27 09:55:22.154", "2026-02-27 10:23:34.617", "2026-02-27 10:24:09.932"]

# Extra cases: second product, paid purchase whose item never arrives, paid then reverted.
EXTRA_ITEM_ROWS = [("2023-03-01 09:00:00", "2023-03-01", "69", "414141", "3", "100.00")]
EXTRA_PURCHASE_ROWS = [
    ("2023-04-01 08:00:00", "2023-04-01", "70", "1", "1", "2023-04-01", "2023-04-01", "1"),
    ("2023-04-02 08:00:00", "2023-04-02", "71", "1", "1", "2023-04-02", "2023-04-02", "1"),
    ("2023-04-05 08:00:00", "2023-04-05", "71", "1", "1", "2023-04-02", None, "1"),
]

# GMV by (release_date, subsidiary) as of each snapshot day, reference events only.
GMV_BY_CUTOFF = {
    "2023-01-19": set(),
    "2023-01-20": {("2023-01-20", "UNKNOWN", 500.0)},
    "2023-01-22": {("2023-01-20", "UNKNOWN", 500.0)},
    "2023-01-23": {("2023-01-20", "nacional", 500.0)},
    "2023-01-26": {("2023-01-20", "nacional", 500.0)},
    "2023-02-05": {("2023-01-20", "nacional", 500.0)},
    "2023-02-26": {("2023-01-20", "nacional", 500.0), ("2023-02-28", "UNKNOWN", 4000.0)},
    "2023-02-28": {("2023-01-20", "nacional", 500.0), ("2023-02-28", "nacional", 4000.0)},
    "2023-03-11": {("2023-01-20", "nacional", 500.0), ("2023-02-28", "nacional", 4000.0)},
    "2023-03-12": {("2023-01-20", "nacional", 500.0), ("2023-02-28", "internacional", 4000.0)},
    "2023-03-31": {("2023-01-20", "nacional", 500.0), ("2023-02-28", "internacional", 4000.0)},
    "2023-07-12": {("2023-01-20", "nacional", 550.0), ("2023-02-28", "internacional", 4000.0)},
    "2023-07-14": {("2023-01-20", "nacional", 550.0), ("2023-02-28", "internacional", 4000.0)},
    "2023-07-15": {("2023-02-28", "internacional", 4000.0), ("2023-03-01", "nacional", 550.0)},
    "2026-02-26": {("2023-02-28", "internacional", 4000.0), ("2023-03-01", "nacional", 550.0)},
}
# Recorded DQ row of the 2026-02-26 run.
RECORDED_DQ = {"total_purchases_asof": 2, "succeded_transactions": 2, "missing_product_item_cnt": 0,
               "missing_extra_info_cnt": 0, "unknown_subsidiary_cnt": 0, "gvm_rows": 2,
               "gmv_total_value": 4550.0}

# Expected with reference + extra events, item grain:
# day -> (mart rows (release, subsidiary, gmv, count), purchases, missing item, missing extra, rows, total)
EXTRA_EXPECTED = {
    "2023-03-31": ({("2023-01-20", "nacional", 500.0, 1), ("2023-02-28", "internacional", 4300.0, 1)},
                   2, 0, 0, 3, 4800.0),
    "2023-04-01": ({("2023-01-20", "nacional", 500.0, 1), ("2023-02-28", "internacional", 4300.0, 1),
                    ("2023-04-01", "UNKNOWN", None, 1)}, 3, 1, 1, 4, 4800.0),
    "2023-04-02": ({("2023-01-20", "nacional", 500.0, 1), ("2023-02-28", "internacional", 4300.0, 1),
                    ("2023-04-01", "UNKNOWN", None, 1), ("2023-04-02", "UNKNOWN", None, 1)}, 4, 2, 2, 5, 4800.0),
    "2023-04-05": ({("2023-01-20", "nacional", 500.0, 1), ("2023-02-28", "internacional", 4300.0, 1),
                    ("2023-04-01", "UNKNOWN", None, 1)}, 3, 1, 1, 4, 4800.0),
    "2023-07-15": ({("2023-02-28", "internacional", 4300.0, 1), ("2023-03-01", "nacional", 550.0, 1),
                    ("2023-04-01", "UNKNOWN", None, 1)}, 3, 1, 1, 4, 4850.0),
}
# --- end of fixed values ---------------------------------------------------------

PURCHASE_COLS = ["transaction_datetime", "transaction_date", "purchase_id", "buyer_id", "prod_item_id",
                 "order_date", "release_date", "producer_id"]
ITEM_COLS = ["transaction_datetime", "transaction_date", "purchase_id", "product_id", "item_quantity",
             "purchase_value"]
EXTRA_COLS = ["transaction_datetime", "transaction_date", "purchase_id", "subsidiary"]


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def raw(spark: SparkSession, rows, cols) -> DataFrame:
    """Rows as strings, like a landing file; columns named only."""
    schema = ", ".join(f"{c} string" for c in cols)
    return spark.createDataFrame(rows, schema)


def delivery(spark: SparkSession, entity, rows, cols, ingestion: str) -> DataFrame:
    typed = bronze.typed_events(raw(spark, rows, cols), entity)
    return bronze.stamp_ingestion(typed, ts(ingestion))


def reference_bronze(spark: SparkSession, with_extra_cases: bool = False) -> dict[str, DataFrame]:
    """Bronze events: purchases delivered three times (first with the wrong
    order_date for purchase 69), items and extra info twice / once."""
    p1 = [r if r[2] != "69" else r[:5] + (FIRST_DELIVERY_ORDER_DATE_69,) + r[6:] for r in PURCHASE_ROWS]
    purchases = delivery(spark, PURCHASE, p1, PURCHASE_COLS, DELIVERIES[0])
    for d in DELIVERIES[1:]:
        purchases = purchases.unionByName(delivery(spark, PURCHASE, PURCHASE_ROWS, PURCHASE_COLS, d))
    items = delivery(spark, PRODUCT_ITEM, ITEM_ROWS, ITEM_COLS, DELIVERIES[0])
    extra = delivery(spark, EXTRA_INFO, EXTRA_ROWS, EXTRA_COLS, DELIVERIES[0]).unionByName(
        delivery(spark, EXTRA_INFO, EXTRA_ROWS, EXTRA_COLS, DELIVERIES[1]))
    if with_extra_cases:
        purchases = purchases.unionByName(
            delivery(spark, PURCHASE, EXTRA_PURCHASE_ROWS, PURCHASE_COLS, DELIVERIES[2]))
        items = items.unionByName(delivery(spark, PRODUCT_ITEM, EXTRA_ITEM_ROWS, ITEM_COLS, DELIVERIES[2]))
    return {"purchase": purchases, "product_item": items, "purchase_extra_info": extra}


def mart_rows(df: DataFrame, with_count: bool = False) -> set:
    out = set()
    for r in df.collect():
        gmv = None if r["gmv_value"] is None else round(r["gmv_value"], 2)
        row = (r["release_date"].isoformat(), r["subsidiary"], gmv)
        out.add(row + (r["transaction_count"],) if with_count else row)
    return out


def col_values(df: DataFrame, col: str) -> list:
    return [r[0] for r in df.select(F.col(col)).collect()]
