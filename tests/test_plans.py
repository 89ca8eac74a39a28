"""Plan-shape checks: the physical plans the operators are designed to produce."""

import datetime as dt
import re

import pytest

from conftest import SF001
from snapledger.model import PRODUCT_ITEM
from snapledger.operators import asof, reports
from snapledger.plans import daily, queries as Q
from snapledger.sources import testmap

STAMP = dt.datetime(2026, 2, 27, 12, 0)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


#: Queries that store tables and return a checkpoint: their work is seen by the second test.
STORING = {"gmv_current", "gmv_latest_window", "gmv_as_seen_on", "lake_gmv_daily", "lake_rerun_day", "ledger_catalog", "stream_silver_purchase",
           "silver_redelivered", "silver_touched_partitions", "asof_purchase_stored", "gmv_restated", "gmv_report_views", "arrival_probe"}


def assert_distributed(p: str, name: str) -> None:
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)
    # A window without PARTITION BY pulls every row into one task, with or without an order.
    for line in p.splitlines():
        if re.match(r"[\s:+|*()0-9-]*Window(GroupLimit)? \[", line):
            assert re.search(r"\], \[\w+#", line) and "Exchange SinglePartition" not in line, (name, line)


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - STORING))
def test_no_python_udf_cross_join_or_global_window(spark, name):
    assert_distributed(plan(Q.QUERIES[name](spark, SF001)), name)


def test_stored_work_is_distributed(spark, monkeypatch):
    """Every plan that storing runs write or checkpoint: merges, index, intervals, gold."""
    from snapledger.sources import storage

    seen = []
    for name in ("staged", "_balanced"):
        def watched(df, *args, work=getattr(storage, name)):
            seen.append(plan(df))
            return work(df, *args)

        monkeypatch.setattr(storage, name, watched)
    for name in ("lake_rerun_day", "asof_purchase_stored"):
        Q.QUERIES[name](spark, SF001)
    assert len(seen) > 40 and any("bit_or" in p for p in seen)
    for p in seen:
        assert_distributed(p, "stored")


def test_as_of_pre_aggregates_before_shuffle(spark):
    p = plan(asof.as_of(Q._events(spark, SF001, PRODUCT_ITEM), PRODUCT_ITEM, Q.ASOF_CUTOFF))
    # Partial WindowGroupLimit below the exchange, final one above it.
    assert p.count("WindowGroupLimit") >= 2
    first_exchange = p.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in p[first_exchange:]


def test_top_k_per_group_is_window_group_limit(spark):
    df = reports.top_products_per_producer(testmap.report_purchase(spark, SF001),
                                           testmap.report_product_item(spark, SF001), 2)
    assert "WindowGroupLimit" in plan(df)


def test_top_n_is_take_ordered(spark):
    df = reports.top_producers(testmap.report_purchase(spark, SF001),
                               testmap.report_product_item(spark, SF001), 1997, 50)
    assert "TakeOrderedAndProject" in plan(df)


def test_items_are_summed_before_the_join(spark):
    """A composite key with very many items shrinks in the map tasks, before any exchange."""
    p, i = testmap.report_purchase(spark, SF001), testmap.report_product_item(spark, SF001)
    for df in (reports.top_producers(p, i, 1997, 50), reports.top_products_per_producer(p, i, 2)):
        lines = plan(df).splitlines()
        scan = next(n for n, x in enumerate(lines) if "FileScan" in x and "l_partkey" in x or "FileScan" in x and "l_quantity" in x)
        above = [x for x in lines[:scan] if "HashAggregate" in x or "Exchange" in x][-2:]
        assert "Exchange" in above[0] and "partial_sum" in above[1], above


def test_current_view_prunes_when_it_runs(spark, lake_root):
    from snapledger.plans import ddl
    from snapledger.sources import storage

    lake = daily.Lake(lake_root)
    for day, n in (("2024-01-01", 1), ("2024-01-02", 5)):
        storage.replace_partitions(spark.sql(f"SELECT DATE'{day}' AS snapshot_date, DATE'2024-01-01' AS release_date, 'x' AS subsidiary, "
                                             f"1.0D AS gmv_value, {n}L AS transaction_count"), lake.mart, ["snapshot_date"])
    views = ddl.publish_reports(spark, lake.mart, "test_views")
    df = spark.sql(f"SELECT transaction_count FROM {views['current']}")
    scan = next(x for x in plan(df).splitlines() if "FileScan" in x and "transaction_count" in x)
    assert "Subquery" in scan.split("PartitionFilters:")[1].split("]")[0]
    assert [r[0] for r in df.collect()] == [5]
    ddl.drop_reports(spark, views)
    assert not spark.catalog.tableExists(views["mart"])


def test_as_of_over_storage_prunes_partitions(spark, lake_root):
    import fixtures as FX

    lake = daily.Lake(lake_root)
    b = FX.reference_bronze(spark)["product_item"]
    daily.ingest(lake, b.drop("ingestion_date"), PRODUCT_ITEM, STAMP)
    daily.run_silver(spark, lake, PRODUCT_ITEM, line_created_at=STAMP)
    df = asof.as_of(daily.read_silver(spark, lake, PRODUCT_ITEM), PRODUCT_ITEM, "2023-02-01")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(transaction_date" in p and "<= 2023-02-01" in p


def test_mart_current_flag_uses_scalar_subquery(spark, lake_root):
    """The newest day is read beside the mart, not by a window over it."""
    p = plan(reports.gmv_current(daily.read_mart(spark, daily.Lake(lake_root))))
    assert "Subquery" in p and "Window" not in p


@pytest.mark.parametrize("name, most", [
    ("bronze_purchase", 1), ("bronze_product_item", 1), ("bronze_extra_info", 4), ("arrival_gate", 6), ("silver_purchase", 4),
    ("silver_purchase_two_batch", 20), ("upsert_purchase", 30), ("silver_product_item_enriched", 16), ("purchase_snapshot", 14),
    ("snapshot_ledger", 16), ("snapshot_backfill", 21)])
def test_scans_in_the_plan_before_it_runs(spark, name, most):
    """Chained operators must not multiply the scans of their inputs."""
    assert plan(Q.QUERIES[name](spark, SF001)).count("FileScan parquet") <= most


def test_backfill_expands_no_versions_into_days(spark):
    p = plan(Q.QUERIES["snapshot_backfill"](spark, SF001))
    below_sums = p[p.index("Window"):]
    assert "snapshot_date" not in below_sums  # days appear only above the running sums


def test_stored_reports_read_one_partition(spark, lake_root):
    from snapledger.sources import storage

    lake = daily.Lake(lake_root)
    storage.replace_partitions(spark.sql("SELECT DATE'2024-01-01' AS snapshot_date, DATE'2024-01-01' AS release_date, 'x' AS subsidiary, "
                                         "1.0D AS gmv_value, 1L AS transaction_count"), lake.mart, ["snapshot_date"])
    mart = daily.read_mart(spark, lake)
    for df in (reports.gmv_current(mart), reports.gmv_latest_window(mart, "2024-01-01", "2024-02-01"), reports.gmv_as_seen_on(mart, "2024-06-01")):
        lines = [x for x in plan(df).splitlines() if "FileScan" in x and "gmv_value" in x]
        assert lines and all("snapshot_date" in x.split("PartitionFilters:")[1].split("]")[0] for x in lines)
        assert df.count() == 1
