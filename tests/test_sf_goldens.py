"""Expected values on the star-schema events at sf0.001 (FIXTURES §4) and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from snapledger.model import ENTITIES
from snapledger.operators import gold, quality, reports
from snapledger.plans import queries as Q
from snapledger.sources import testmap

# --- fixed values: expected as-of results at sf0.001 (item grain) ---------------
# day: (rows, purchases, missing item, missing extra, GMV, mart rows, GMV at purchase grain)
EXPECTED = {
    dt.date(1996, 12, 31): (475, 304, 88, 46, 524_538_068.62, 296, 279_032_238.52),
    dt.date(1998, 6, 30): (1_190, 537, 64, 132, 1_456_224_807.97, 520, 595_448_661.90),
    dt.date(2001, 12, 31): (4_046, 1_007, 16, 429, 5_414_518_435.45, 980, 1_357_761_279.17),
}
EVENT_COUNTS = {"purchase": (2_722, 2_507), "product_item": (6_575, 6_000), "purchase_extra_info": (1_454, 1_454)}
TOP_PRODUCERS = [(14, 32_778_552.29), (125, 30_200_402.02)]
QUALIFYING_PRODUCERS = 89
# --- end of fixed values ----------------------------------------------------------


@pytest.fixture(scope="module")
def ledger(spark):
    return Q._ledger(spark, SF001).cache()


@pytest.fixture(scope="module")
def ledger_purchase_grain(spark):
    return Q._ledger(spark, SF001, grain="purchase").cache()


def test_event_counts(spark):
    for name, (events, distinct) in EVENT_COUNTS.items():
        s = Q._silver(spark, SF001, ENTITIES[name])
        assert Q._bronze(spark, SF001, ENTITIES[name]).count() == events
        assert s.count() == distinct


def test_as_of_results(ledger, ledger_purchase_grain):
    dq = {r["snapshot_date"]: r for r in quality.dq_metrics(ledger).collect()}
    mart = gold.gmv_by_subsidiary(ledger).groupBy("snapshot_date").count().collect()
    mart_rows = {r["snapshot_date"]: r["count"] for r in mart}
    pg = {r["snapshot_date"]: r["g"] for r in ledger_purchase_grain.groupBy("snapshot_date").agg(
        F.sum(F.col("item_quantity") * F.col("purchase_value")).cast("double").alias("g")).collect()}
    for day, (rows, purchases, miss_item, miss_extra, gmv, n_mart, gmv_pg) in EXPECTED.items():
        r = dq[day]
        assert (r["gvm_rows"], r["total_purchases_asof"], r["missing_product_item_cnt"],
                r["missing_extra_info_cnt"]) == (rows, purchases, miss_item, miss_extra), day
        assert round(r["gmv_total_value"], 2) == gmv
        assert mart_rows[day] == n_mart
        assert round(pg[day], 2) == gmv_pg


def test_rerun_of_a_day_is_a_no_op(spark, ledger):
    day = dt.date(1998, 6, 30)
    photo = Q._snapshot(Q._all_events(spark, SF001), day)
    again = gold.append_snapshot(ledger, photo, day)
    key = ["snapshot_date", "purchase_id", "product_id"]
    assert again.count() == ledger.count()
    assert again.select(*key).exceptAll(ledger.select(*key)).count() == 0


def test_single_day_snapshot_equals_ledger_day(spark, ledger):
    day = dt.date(1998, 6, 30)
    photo = Q._snapshot(Q._all_events(spark, SF001), day).drop("snapshot_datetime")
    part = ledger.filter(F.col("snapshot_date") == F.lit(day)).drop("snapshot_datetime")
    assert photo.exceptAll(part).count() == 0 and part.exceptAll(photo).count() == 0


def test_mart_total_equals_dq_total_and_quarantine_count(ledger):
    mart = {r["snapshot_date"]: r["g"] for r in gold.gmv_by_subsidiary(ledger).groupBy("snapshot_date")
            .agg(F.sum("gmv_value").alias("g")).collect()}
    dq = {r["snapshot_date"]: r for r in quality.dq_metrics(ledger).collect()}
    quar = {r["snapshot_date"]: r["count"] for r in
            quality.quarantine_missing_items(ledger).groupBy("snapshot_date").count().collect()}
    for day, r in dq.items():
        assert abs(mart[day] - r["gmv_total_value"]) < 1e-3
        assert quar.get(day, 0) == r["missing_product_item_cnt"]


def test_at_most_one_current_row_per_key(spark):
    for e in ENTITIES.values():
        s = Q._silver(spark, SF001, e)
        per_key = s.groupBy(*e.business_key).agg(F.sum(F.col("is_current_record").cast("int")).alias("n"))
        assert per_key.filter("n <> 1").count() == 0


def test_top_producers(spark):
    p, i = testmap.report_purchase(spark, SF001), testmap.report_product_item(spark, SF001)
    top = reports.top_producers(p, i, Q.REPORT_YEAR, 1000).collect()
    assert len(top) == QUALIFYING_PRODUCERS
    assert [(r["producer_id"], round(r["total_revenue"], 2)) for r in top[:2]] == TOP_PRODUCERS


def test_top_products_per_producer_keeps_k(spark):
    p, i = testmap.report_purchase(spark, SF001), testmap.report_product_item(spark, SF001)
    out = reports.top_products_per_producer(p, i, 2)
    assert out.groupBy("producer_id").count().filter("count > 2").count() == 0
