"""Bronze -> silver with Structured Streaming (availableNow + foreachBatch)."""

import datetime as dt

from pyspark.sql import functions as F

import fixtures as FX
from snapledger.model import PURCHASE
from snapledger.operators import silver
from snapledger.plans import daily
from snapledger.streaming.incremental import silver_stream

STAMP = dt.datetime(2026, 2, 27, 12, 0)


import pytest


@pytest.mark.parametrize("layout", ["day", "month"])
def test_stream_silver_equals_batch(spark, lake_root, layout):
    lake = daily.Lake(lake_root, event_partition=layout)
    b = FX.reference_bronze(spark)["purchase"]
    ckpt = lake_root + "/_checkpoints/silver_purchase"
    for d in FX.DELIVERIES:
        part = b.filter(F.col("ingestion_date") == F.lit(FX.ts(d)))
        daily.ingest(lake, part.drop("ingestion_date"), PURCHASE, FX.ts(d))
        q = silver_stream(spark, PURCHASE, lake, ckpt, STAMP)
        q.awaitTermination(120)
    got = daily.read_silver(spark, lake, PURCHASE)
    want = silver.build_silver(b, PURCHASE, line_created_at=STAMP)
    cols = [c for c in want.columns if c != "line_created_at"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    # A restart with no new files changes nothing.
    q = silver_stream(spark, PURCHASE, lake, ckpt, STAMP)
    q.awaitTermination(120)
    assert daily.read_silver(spark, lake, PURCHASE).count() == 5
