"""Reruns replace a whole day, also when it becomes empty; killed silver runs recover."""

import datetime as dt
import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from snapledger.model import ENTITIES, PRODUCT_ITEM, PURCHASE
from snapledger.plans import daily
from snapledger.sources import storage

DAY = dt.date(2024, 1, 10)


def at(day: int, hour: int = 0) -> dt.datetime:
    return dt.datetime(2024, 1, day, hour)


def deliver(spark, lake, name: str, rows: list[dict], when: dt.datetime) -> None:
    entity = ENTITIES[name]
    plain = [{**r, "transaction_datetime": str(r["when"]), "transaction_date": str(r["when"].date())} for r in rows]
    cols = [f.name for f in entity.bronze_schema.fields if f.name != "ingestion_date"]
    raw = spark.createDataFrame([tuple(None if r.get(c) is None else str(r[c]) for c in cols) for r in plain], ", ".join(f"{c} string" for c in cols))
    daily.ingest(lake, raw, entity, when)


def purchase(pid: int, when: dt.datetime, released: dt.date | None) -> dict:
    return {"when": when, "purchase_id": pid, "buyer_id": 1, "prod_item_id": pid, "order_date": when.date(), "release_date": released, "producer_id": 2}


def run(spark, lake, stamp: dt.datetime) -> None:
    for e in ENTITIES.values():
        daily.run_silver(spark, lake, e, line_created_at=at(1))
    daily.run_gold(spark, lake, DAY, stamp)


def state(spark, lake) -> dict:
    dq = daily.dq_view(spark, lake).where(F.col("snapshot_date") == F.lit(DAY)).collect()
    return {"ledger": daily.read_ledger(spark, lake).count(), "mart": daily.read_mart(spark, lake).count(),
            "quarantine": daily.quarantine_view(spark, lake).count(),
            "dq": [(r["total_purchases_asof"], r["missing_product_item_cnt"], r["gvm_rows"], r["gmv_total_value"]) for r in dq]}


@pytest.mark.parametrize("partition", [("snapshot_date",), ("snapshot_date", "transaction_date")])
def test_rerun_replaces_a_day_that_becomes_empty(spark, lake_root, partition):
    lake = daily.Lake(lake_root, ledger_partition=partition)
    deliver(spark, lake, "purchase", [purchase(70, at(3), at(4).date())], at(5))
    run(spark, lake, at(11))
    assert state(spark, lake) == {"ledger": 1, "mart": 1, "quarantine": 1, "dq": [(1, 1, 1, None)]}
    # The item arrives late; the day is run again.
    item = {"when": at(3), "purchase_id": 70, "product_id": 9, "item_quantity": 2, "purchase_value": "5.00"}
    deliver(spark, lake, "product_item", [item], at(12))
    run(spark, lake, at(12, 1))
    assert state(spark, lake) == {"ledger": 1, "mart": 1, "quarantine": 0, "dq": [(1, 0, 1, 10.0)]}
    # The purchase is reverted as of the day: nothing of it may stay.
    deliver(spark, lake, "purchase", [purchase(70, at(10), None)], at(13))
    run(spark, lake, at(13, 1))
    assert state(spark, lake) == {"ledger": 0, "mart": 0, "quarantine": 0, "dq": [(0, 0, 0, None)]}


def test_two_level_ledger_keeps_other_days(spark, lake_root):
    lake = daily.Lake(lake_root, ledger_partition=("snapshot_date", "transaction_date"))
    deliver(spark, lake, "purchase", [purchase(1, at(3), at(4).date()), purchase(2, at(5), at(6).date())], at(7))
    run(spark, lake, at(11))
    before = daily.read_ledger(spark, lake).where(F.col("snapshot_date") == F.lit(DAY)).collect()
    daily.run_gold(spark, lake, dt.date(2024, 1, 4), at(12))
    got = daily.read_ledger(spark, lake)
    assert sorted(map(str, got.where(F.col("snapshot_date") == F.lit(DAY)).collect())) == sorted(map(str, before))
    assert [(r["purchase_id"]) for r in got.where(F.col("snapshot_date") == "2024-01-04").collect()] == [1]
    assert os.path.isdir(f"{lake.ledger}/snapshot_date=2024-01-04/transaction_date=2024-01-03")


@pytest.mark.parametrize("event_partition", ["day", "month"])
def test_killed_silver_run_is_rebuilt(spark, lake_root, event_partition):
    def silver_rows(lake):
        rows = daily.read_silver(spark, lake, PURCHASE).drop("line_created_at").collect()
        return sorted(map(str, rows))

    whole, killed = (daily.Lake(f"{lake_root}/{n}", event_partition=event_partition) for n in ("whole", "killed"))
    first = [purchase(i, at(2 + i), None) for i in range(1, 6)]
    second = [purchase(i, at(12 + i), at(13 + i).date()) for i in range(1, 4)]
    for lake in (whole, killed):
        for rows, when in ((first, at(9)), (second, at(19))):
            deliver(spark, lake, "purchase", rows, when)
            daily.run_silver(spark, lake, PURCHASE, line_created_at=at(1))
    # As a driver lost during the commit leaves it: pending, and a partition gone.
    storage.make_folder(spark, killed.pending(PURCHASE))
    shutil.rmtree(sorted(glob.glob(f"{killed.silver(PURCHASE)}/{killed.event_part_col}=*"))[0])
    daily.run_silver(spark, killed, PURCHASE, line_created_at=at(1))
    assert silver_rows(killed) == silver_rows(whole)
    assert not storage.exists(spark, killed.pending(PURCHASE))


def test_late_rows_with_an_older_stamp_are_read(spark, lake_root):
    lake = daily.Lake(lake_root)
    deliver(spark, lake, "purchase", [purchase(1, at(2), None)], at(5, 12))
    daily.run_silver(spark, lake, PURCHASE, line_created_at=at(1))
    deliver(spark, lake, "purchase", [purchase(2, at(2), None)], at(5, 12))  # the mark itself
    deliver(spark, lake, "purchase", [purchase(3, at(2), None)], at(5, 2))
    daily.run_silver(spark, lake, PURCHASE, line_created_at=at(1))
    assert sorted(r["purchase_id"] for r in daily.read_silver(spark, lake, PURCHASE).collect()) == [1, 2, 3]


def test_incremental_silver_reads_touched_partitions_only(spark, lake_root):
    lake = daily.Lake(lake_root)
    items = [{"when": at(d), "purchase_id": d, "product_id": 1, "item_quantity": 1, "purchase_value": "1.00"} for d in range(1, 9)]
    deliver(spark, lake, "product_item", items, at(9))
    daily.run_silver(spark, lake, PRODUCT_ITEM, line_created_at=at(1))
    files = set(glob.glob(f"{lake.silver(PRODUCT_ITEM)}/*/*.parquet"))
    deliver(spark, lake, "product_item", [{**items[2], "item_quantity": 5}], at(20))
    daily.run_silver(spark, lake, PRODUCT_ITEM, line_created_at=at(1), overlap=None)
    after = set(glob.glob(f"{lake.silver(PRODUCT_ITEM)}/*/*.parquet"))
    assert {os.path.basename(os.path.dirname(f)) for f in files ^ after} == {"transaction_date=2024-01-03"}
    got = {r["purchase_id"]: r["item_quantity"] for r in daily.read_silver(spark, lake, PRODUCT_ITEM).collect()}
    assert got == {**dict.fromkeys(range(1, 9), 1), 3: 5}


@pytest.mark.parametrize("writes", [0, 1, 2, 3])
def test_gold_run_killed_between_its_writes(spark, lake_root, monkeypatch, writes):
    """The next run, of another day, makes the four tables of the day agree again."""
    lake = daily.Lake(lake_root, event_partition="month")
    deliver(spark, lake, "purchase", [purchase(70, at(3), at(4).date())], at(5))
    run(spark, lake, at(11))
    item = {"when": at(3), "purchase_id": 70, "product_id": 9, "item_quantity": 2, "purchase_value": "5.00"}
    deliver(spark, lake, "product_item", [item], at(12))
    daily.run_silver(spark, lake, PRODUCT_ITEM, line_created_at=at(1))
    done, write = [], storage.replace_partitions

    def killed(*args, **kw):
        if len(done) == writes:
            raise KeyboardInterrupt
        done.append(1)
        write(*args, **kw)

    monkeypatch.setattr(storage, "replace_partitions", killed)
    with pytest.raises(KeyboardInterrupt):
        daily.run_gold(spark, lake, DAY, at(12, 1))
    monkeypatch.setattr(storage, "replace_partitions", write)
    assert daily.unfinished_days(spark, lake) == [DAY]
    daily.run_gold(spark, lake, at(2).date(), at(13))  # a day without purchases
    assert daily.unfinished_days(spark, lake) == []
    got = state(spark, lake)
    assert (got["ledger"], got["mart"], got["quarantine"], got["dq"]) == (1, 1, 0, [(1, 0, 1, 10.0)])
