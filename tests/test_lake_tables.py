"""Tables kept beside silver: key index, validity intervals, changes and restated days."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

import fixtures as FX
from snapledger.model import ENTITIES, PRODUCT_ITEM, PURCHASE
from snapledger.operators import asof, backfill, gold, keyindex, silver, states
from snapledger.plans import daily
from snapledger.sources import storage
from test_plans import plan
from test_reruns import at, deliver, purchase

STAMP = dt.datetime(2026, 2, 27, 12, 0)


def rows_of(df):
    return sorted(map(str, df.collect()))


def item(pid, product, when, value, quantity=1):
    return {"when": when, "purchase_id": pid, "product_id": product, "item_quantity": quantity, "purchase_value": value}


def extra(pid, when, subsidiary):
    return {"when": when, "purchase_id": pid, "subsidiary": subsidiary}


# ---------------------------------------------------------------- key index


def test_lookup_misses_no_partition(spark):
    rng = random.Random(1)
    held = [(rng.randint(-10**12, 10**12), dt.date(2024, rng.randint(1, 12), 1)) for _ in range(3000)]
    held += [(i, dt.date(2025, 1, 1)) for i in range(20_000)]  # a partition of many blocks
    rows = spark.createDataFrame(held, "purchase_id long, part date")
    index = storage.staged(keyindex.partition_index(rows, "purchase_id", "part").withColumn("run", F.lit(1)))
    big = index.where("part = '2025-01-01'")
    assert big.count() > 10 and big.agg(F.sum("held")).first()[0] == 20_000
    where = {}
    for k, p in held:
        where.setdefault(k, set()).add(p)
    for n in (1, 40):
        some = rng.sample(sorted(where), n)
        got = keyindex.partitions_with(index, spark.createDataFrame([(k,) for k in some], "key long"), "part")
        want = set().union(*(where[k] for k in some))
        assert want <= set(got) and got == sorted(got)
        assert len(set(got) - want) <= 1, (n, got, want)
    strange = spark.createDataFrame([(10**15,), (20_500,)], "key long")
    assert keyindex.partitions_with(index, strange, "part") == []
    assert keyindex.partitions_with(index.limit(0), strange, "part") == []


def test_increment_opens_touched_partitions_only(spark, lake_root):
    """Silver files of other partitions can't be read here, and needn't be."""
    lake = daily.Lake(lake_root)
    deliver(spark, lake, "product_item", [item(d, 1, at(d), "1.00") for d in range(1, 9)], at(9))
    daily.run_silver(spark, lake, PRODUCT_ITEM, line_created_at=at(1))
    for f in glob.glob(f"{lake.silver(PRODUCT_ITEM)}/*/*.parquet"):
        if "2024-01-03" not in f:
            with open(f, "wb") as broken:
                broken.write(b"not a table")
            crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    deliver(spark, lake, "product_item", [item(3, 1, at(3), "5.00")], at(20))
    daily.run_silver(spark, lake, PRODUCT_ITEM, line_created_at=at(1), overlap=None)
    got = daily.silver_parts(spark, lake, PRODUCT_ITEM, [at(3).date()]).collect()
    assert [str(r["purchase_value"]) for r in got] == ["5.00"]
    p = plan(daily.silver_parts(spark, lake, PRODUCT_ITEM, [at(3).date()]))
    filters = p.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "transaction_date" in filters and "2024-01-03" in filters


def test_index_follows_the_merges(spark, lake_root, monkeypatch):
    lake = daily.Lake(lake_root, event_partition="month")
    monkeypatch.setattr(daily, "INDEX_RUNS", 2)  # runs are joined on the way
    rng = random.Random(3)
    for step in range(4):
        rows = [item(rng.randint(1, 30), rng.randint(1, 3), at(rng.randint(1, 28)), "2.00") for _ in range(25)]
        deliver(spark, lake, "product_item", rows, at(28, step))
        daily.run_silver(spark, lake, PRODUCT_ITEM, line_created_at=at(1))
        fresh = keyindex.partition_index(daily.silver_parts(spark, lake, PRODUCT_ITEM), "purchase_id", lake.event_part_col)
        stored = keyindex.newest(daily.read_index(spark, lake, PRODUCT_ITEM), lake.event_part_col)
        assert rows_of(stored.select(fresh.columns)) == rows_of(fresh)
        assert len(storage.folder_values(spark, lake.index(PRODUCT_ITEM), "run")) <= 2
    # A lake written before there was an index gets one.
    storage.remove(spark, lake.index(PRODUCT_ITEM))
    deliver(spark, lake, "product_item", [item(1, 1, at(2), "9.00")], at(28, 9))
    daily.run_silver(spark, lake, PRODUCT_ITEM, line_created_at=at(1))
    whole = silver.build_silver(daily.read_bronze(spark, lake, PRODUCT_ITEM), PRODUCT_ITEM, line_created_at=at(1))
    names = [c for c in whole.columns if c != "line_created_at"]
    assert rows_of(daily.read_silver(spark, lake, PRODUCT_ITEM).select(names)) == rows_of(whole.select(names))


# ---------------------------------------------------------------- redeliveries


@pytest.mark.parametrize("values", [("50.00", "90.00"), ("90.00", "50.00"), ("50.00", None), (None, "50.00")])
def test_redelivery_under_the_same_stamp(spark, lake_root, values):
    """Incremental silver equals rebuilt silver, whatever comes first."""
    lake = daily.Lake(lake_root)
    for v in values:
        deliver(spark, lake, "product_item", [item(1, 1, at(3), v)], at(5))
        daily.run_silver(spark, lake, PRODUCT_ITEM, line_created_at=at(1))
    kept = rows_of(daily.read_silver(spark, lake, PRODUCT_ITEM))
    daily.rebuild_silver(spark, lake, PRODUCT_ITEM, line_created_at=at(1))
    assert rows_of(daily.read_silver(spark, lake, PRODUCT_ITEM)) == kept
    best = max(v for v in values if v)
    assert [str(r["purchase_value"]) for r in daily.read_silver(spark, lake, PRODUCT_ITEM).collect()] == [best]


def test_rows_held_as_delivered_touch_nothing(spark, lake_root):
    lake = daily.Lake(lake_root)
    deliver(spark, lake, "product_item", [item(1, 1, at(3), None), item(2, 1, at(4), "1.00")], at(5))
    daily.run_silver(spark, lake, PRODUCT_ITEM, line_created_at=at(1))
    files = sorted(glob.glob(f"{lake.silver(PRODUCT_ITEM)}/*/*.parquet"))
    daily.run_silver(spark, lake, PRODUCT_ITEM, line_created_at=at(1))
    assert sorted(glob.glob(f"{lake.silver(PRODUCT_ITEM)}/*/*.parquet")) == files


# ---------------------------------------------------------------- stored states


def random_batch(rng, lake, spark, hour):
    """One delivery of each entity: new, late and corrected events."""
    ps = [purchase(rng.randint(1, 25), at(rng.randint(1, 28)), rng.choice([None, at(rng.randint(1, 28)).date()])) for _ in range(12)]
    items = [item(rng.randint(1, 25), rng.randint(1, 3), at(rng.randint(1, 28)), f"{rng.randint(1, 50)}.50", rng.randint(1, 4)) for _ in range(12)]
    extras = [extra(rng.randint(1, 25), at(rng.randint(1, 28)), rng.choice(["NORTH", "SOUTH", None])) for _ in range(8)]
    for name, rows in (("purchase", ps), ("product_item", items), ("purchase_extra_info", extras)):
        deliver(spark, lake, name, rows, at(28, hour))
        daily.run_silver(spark, lake, ENTITIES[name], line_created_at=at(1))


def test_states_equal_as_of_on_golden_days(spark, lake_root):
    lake = daily.Lake(lake_root, states=True)
    bronze = FX.reference_bronze(spark)
    for d in FX.DELIVERIES:
        for name, e in ENTITIES.items():
            daily.ingest(lake, bronze[name].filter(F.col("ingestion_date") == F.lit(FX.ts(d))).drop("ingestion_date"), e, FX.ts(d))
            daily.run_silver(spark, lake, e, line_created_at=STAMP)
    last = max(FX.GMV_BY_CUTOFF)
    for day, want in FX.GMV_BY_CUTOFF.items():
        for e in ENTITIES.values():
            stored = daily.read_silver(spark, lake, e)
            got = states.as_of_states(daily.read_states(spark, lake, e), e, day)
            assert rows_of(got.select(sorted(got.columns))) == rows_of(asof.as_of(stored, e, day).select(sorted(got.columns))), (day, e.name)
        photo = daily.snapshot(spark, lake, day, STAMP)
        if day == last:
            assert FX.mart_rows(gold.gmv_daily(photo)) == want


def test_states_follow_random_late_batches(spark, lake_root):
    lake = daily.Lake(lake_root, event_partition="month", states=True)
    rng = random.Random(7)
    for hour in range(3):
        random_batch(rng, lake, spark, hour)
        for e in ENTITIES.values():
            want = states.states_of(daily.read_silver(spark, lake, e), e)
            assert rows_of(daily.read_states(spark, lake, e).select(want.columns)) == rows_of(want), (hour, e.name)
    daily.rebuild_silver(spark, lake, PURCHASE, line_created_at=at(1))
    want = states.states_of(daily.read_silver(spark, lake, PURCHASE), PURCHASE)
    assert rows_of(daily.read_states(spark, lake, PURCHASE).select(want.columns)) == rows_of(want)


def test_state_of_a_day_is_a_pruned_scan(spark, lake_root):
    lake = daily.Lake(lake_root, states=True)
    deliver(spark, lake, "purchase", [purchase(1, at(3), at(4).date()), purchase(1, at(9), None)], at(10))
    daily.run_silver(spark, lake, PURCHASE, line_created_at=at(1))
    df = states.as_of_states(daily.read_states(spark, lake, PURCHASE), PURCHASE, "2024-01-05")
    p = plan(df)
    filters = p.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "until_month" in filters and "since_month" in filters
    assert "Exchange" not in p and "Window" not in p
    assert [r["release_date"] for r in df.collect()] == [at(4).date()]


# ---------------------------------------------------------------- restated days


def full_mart(spark, lake, days):
    rows = [daily.read_silver(spark, lake, e) for e in ENTITIES.values()]
    return backfill.gmv_of_days(*rows, days)


def test_restated_days_equal_full_recomputation(spark, lake_root):
    lake = daily.Lake(lake_root, event_partition="month", changes=True)
    rng = random.Random(11)
    days = [at(d).date() for d in (2, 9, 16, 28)]
    random_batch(rng, lake, spark, 0)
    assert daily.restate(spark, lake, days[:3]) == days[:3]
    for hour in range(1, 4):
        random_batch(rng, lake, spark, hour)
        if hour == 2:
            continue  # two merges of each entity before one restatement
        daily.restate(spark, lake, days if hour > 2 else None)
        want = full_mart(spark, lake, days if hour > 2 else days[:3])
        assert rows_of(daily.restated_view(spark, lake)) == rows_of(want), hour
    assert daily.restate(spark, lake) == []


def test_restatement_rewrites_altered_days_only(spark, lake_root):
    lake = daily.Lake(lake_root, changes=True)
    deliver(spark, lake, "purchase", [purchase(i, at(2), at(3).date()) for i in range(1, 4)], at(4))
    deliver(spark, lake, "product_item", [item(i, 1, at(2), "10.00") for i in range(1, 4)], at(4))
    for e in ENTITIES.values():
        daily.run_silver(spark, lake, e, line_created_at=at(1))
    days = [at(d).date() for d in (5, 10, 15)]
    daily.restate(spark, lake, days)
    files = {f for f in glob.glob(f"{lake.restated}/*/*.parquet")}
    deliver(spark, lake, "product_item", [item(2, 1, at(8), "25.00")], at(20))
    daily.run_silver(spark, lake, PRODUCT_ITEM, line_created_at=at(1))
    assert daily.restate(spark, lake) == days[1:]
    after = {f for f in glob.glob(f"{lake.restated}/*/*.parquet")}
    assert {os.path.basename(os.path.dirname(f)) for f in files ^ after} == {"snapshot_date=2024-01-10", "snapshot_date=2024-01-15"}
    got = {r["snapshot_date"]: r["gmv_value"] for r in daily.restated_view(spark, lake).collect()}
    assert got == {days[0]: 30.0, days[1]: 45.0, days[2]: 45.0}
    # A purchase that is reverted leaves its group; a day left without groups is cleared.
    deliver(spark, lake, "purchase", [purchase(i, at(12), None) for i in (1, 2, 3)], at(21))
    daily.run_silver(spark, lake, PURCHASE, line_created_at=at(1))
    assert daily.restate(spark, lake) == days[2:]
    assert {r["snapshot_date"] for r in daily.restated_view(spark, lake).collect()} == set(days[:2])


def test_killed_restatement_and_rebuilt_silver_are_computed_in_full(spark, lake_root):
    lake = daily.Lake(lake_root, event_partition="month", changes=True)
    rng = random.Random(5)
    days = [at(9).date(), at(20).date()]
    random_batch(rng, lake, spark, 0)
    daily.restate(spark, lake, days)
    random_batch(rng, lake, spark, 1)
    storage.make_folder(spark, lake.restated_pending)  # as a driver lost in the middle leaves it
    assert daily.restate(spark, lake) == days
    assert rows_of(daily.restated_view(spark, lake)) == rows_of(full_mart(spark, lake, days))
    random_batch(rng, lake, spark, 2)
    daily.rebuild_silver(spark, lake, PURCHASE, line_created_at=at(1))
    assert daily.restate(spark, lake) == days
    assert rows_of(daily.restated_view(spark, lake)) == rows_of(full_mart(spark, lake, days))


def test_restate_needs_a_lake_with_changes(spark, lake_root):
    with pytest.raises(ValueError):
        daily.restate(spark, daily.Lake(lake_root))
